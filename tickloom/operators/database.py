"""A day's tables in a database: executors fill staging tables with constraints, one transaction puts them all in place."""

from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from ..scratch import kept

#: Column types by database, for text that a key may hold, longer text and whole numbers; and how a table is renamed.
DIALECTS = {
    "derby": {"text": "VARCHAR(4000)", "long": "CLOB", "bigint": "BIGINT", "rename": 'RENAME TABLE "{s}"."{t}" TO "{n}"'},
    "": {"text": "TEXT", "long": "TEXT", "bigint": "BIGINT", "rename": 'ALTER TABLE "{s}"."{t}" RENAME TO "{n}"'},
}
NEW, OLD = "__new", "__old"


@contextmanager
def transaction(spark: SparkSession, url: str, properties: dict):
    """A function that runs SQL on the driver's connection; what it did is there as a whole after the block, or not at all."""
    jvm = spark.sparkContext._jvm
    props = jvm.java.util.Properties()
    for k, v in properties.items():
        props.setProperty(k, v)
    conn = jvm.java.sql.DriverManager.getConnection(url, props)
    try:
        conn.setAutoCommit(False)
        statement = conn.createStatement()

        def run(sql: str) -> None:
            statement.execute(sql)

        def names(schema: str) -> set | None:
            """The schema's tables, None where there is no such schema."""
            known, found = conn.getMetaData().getSchemas(), False
            while known.next():
                found = found or known.getString(1) == schema
            tables, out = conn.getMetaData().getTables(None, schema, "%", None), set()
            while tables.next():
                out.add(tables.getString(3))
            return out if found else None

        run.names = names
        yield run
        conn.commit()
    except BaseException:
        conn.rollback()
        raise
    finally:
        conn.close()


def definition(df: DataFrame, required: tuple, long: tuple, dialect: dict) -> str:
    """The columns of a CREATE TABLE; texts that may be null are long ones, as Spark writes a null to Derby as such."""
    kind = lambda c, t: dialect["bigint" if t == "bigint" else "text" if c in required and c not in long else "long"]
    return ", ".join(f'"{c}" {kind(c, t)}{" NOT NULL" if c in required else ""}' for c, t in df.dtypes)


def load(spark: SparkSession, tables: list, url: str, batch: int = 10_000, **properties) -> None:
    """tables: (schema, name, df, columns that must have a value, columns of long text), all replaced at once.

    df has texts and longs. Schemas are made where they lack. Executors write to staging tables, each partition in a transaction of its
    own; a partition that a lost task wrote already shows in the number of rows, which ends the load, as a violated constraint does, and
    leaves the tables as they were. The last transaction only renames: the database's readers see all of yesterday or all of today.
    A load that broke off leaves staging tables, which the next one replaces. A table that two schemas share is computed once.
    """
    dialect = next((d for k, d in DIALECTS.items() if k and url.startswith(f"jdbc:{k}")), DIALECTS[""])
    once: dict = {}
    with transaction(spark, url, properties) as run:
        for schema in dict.fromkeys(t[0] for t in tables):
            if run.names(schema) is None:
                run(f'CREATE SCHEMA "{schema}"')
        for schema, name, df, required, long in tables:
            if name + NEW in run.names(schema):
                run(f'DROP TABLE "{schema}"."{name}{NEW}"')
            run(f'CREATE TABLE "{schema}"."{name}{NEW}" ({definition(df, required, long, dialect)})')
    for schema, name, df, *_ in tables:
        if id(df) not in once:
            once[id(df)] = kept(df)
        rows, target = once[id(df)], f'"{schema}"."{name}{NEW}"'
        rows.write.format("jdbc").options(url=url, dbtable=target, batchsize=batch, **properties).mode("append").save()
        there = spark.read.format("jdbc").options(url=url, dbtable=target, **properties).load().count()
        if there != rows.count():
            raise RuntimeError(f"{schema}.{name}: {there} rows were written for {rows.count()}")
    with transaction(spark, url, properties) as run:
        for schema, name, *_ in tables:
            known = run.names(schema)
            if name + OLD in known:
                run(f'DROP TABLE "{schema}"."{name}{OLD}"')
            if name in known:
                run(dialect["rename"].format(s=schema, t=name, n=name + OLD))
            run(dialect["rename"].format(s=schema, t=name + NEW, n=name))
    with transaction(spark, url, properties) as run:
        for schema, name, *_ in tables:
            if name + OLD in run.names(schema):
                run(f'DROP TABLE "{schema}"."{name}{OLD}"')
