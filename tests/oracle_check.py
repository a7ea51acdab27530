"""Run registered queries and their SQL side by side: python tests/oracle_check.py FOLDER [NAME ...]"""

import pathlib
import sys
import time

import duckdb

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parents[1]))

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]


def database(folder):
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    return con


def canonical(frame):
    """Rows as a sorted list of texts, columns by name; kinds of the columns beside."""
    frame = frame[sorted(frame.columns)]
    rows = sorted(map(str, frame.astype(object).itertuples(index=False, name=None)))
    return list(frame.columns), rows


def difference(spark_frame, sql_frame):
    (names, rows), (sql_names, sql_rows) = canonical(spark_frame), canonical(sql_frame)
    if names != sql_names:
        return f"columns {names} against {sql_names}"
    if len(rows) != len(sql_rows):
        return f"{len(rows)} rows against {len(sql_rows)}"
    for row, sql_row in zip(rows, sql_rows):
        if row != sql_row:
            return f"{row} against {sql_row}"
    return None


def main():
    import __spark_entry__ as contract
    from tests.conftest import make_session

    folder, names = sys.argv[1], sys.argv[2:]
    spark, con = make_session(), database(folder)
    failed = []
    for name, query in contract.queries().items():
        if names and name not in names:
            continue
        begin = time.time()
        result = query(spark, folder).toPandas()
        took = time.time() - begin
        sql = contract.oracle_sql().get(name)
        begin = time.time()
        wrong = difference(result, con.execute(sql).df()) if sql else "no SQL"
        print(f"{name:32} {len(result):8} rows {took:6.2f}s sql {time.time() - begin:6.2f}s  {wrong or 'same'}", flush=True)
        if wrong:
            failed.append(name)
    print("failed:", failed)


if __name__ == "__main__":
    main()
