"""Compares a query of this package with its SQL on the tables of a folder."""

import duckdb

TABLES = "documents embeddings pages benchmark labels conversations".split()


def check_sql(spark, folder, run, sql):
    duck = duckdb.connect()
    for name in TABLES:
        duck.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    answer = duck.execute(sql)
    columns = sorted(d[0] for d in answer.description)
    places = {d[0]: i for i, d in enumerate(answer.description)}
    found = run(spark, folder)
    assert sorted(found.columns) == columns
    wanted = sorted((tuple(r[places[c]] for c in columns) for r in answer.fetchall()), key=str)
    assert sorted((tuple(r[c] for c in columns) for r in found.collect()), key=str) == wanted
