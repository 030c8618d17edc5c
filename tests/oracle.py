"""Holds a query's rows against DuckDB's for its SQL."""

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def rows_of(df):
    cols = sorted(df.columns)
    return cols, sorted(map(repr, df[cols].astype(object).where(df[cols].notna(), None).itertuples(index=False, name=None)))


def check(spark, query, sql, sf_dir):
    db = duckdb.connect()
    for t in TABLES:
        db.execute(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    assert rows_of(query(spark, sf_dir).toPandas()) == rows_of(db.execute(sql).fetchdf())
