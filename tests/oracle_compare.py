"""Run registered queries on Spark and their SQL on DuckDB and compare rows."""

import math
import sys
import time

sys.path.insert(0, "/root/repo")
if "/opt/oracle" not in sys.path:
    sys.path.append("/opt/oracle")

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def duck(sf_dir):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else repr(value + 0.0)
    if isinstance(value, bool):
        return str(value)
    return None if value is None else str(value)


def spark_rows(df):
    names = sorted(df.columns)
    rows = df.select(*names).collect()
    return names, sorted([tuple(plain(v) for v in row) for row in rows], key=repr)


def duck_rows(connection, sql):
    result = connection.execute(sql)
    names = [d[0] for d in result.description]
    order = sorted(range(len(names)), key=names.__getitem__)
    types = {names[i]: str(result.description[i][1]) for i in order}
    rows = [tuple(plain(row[i]) for i in order) for row in result.fetchall()]
    return [names[i] for i in order], sorted(rows, key=repr), types


SQL_TYPES = {
    "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR",
    "boolean": "BOOLEAN", "timestamp": "TIMESTAMP WITH TIME ZONE", "date": "DATE",
    "timestamp_ntz": "TIMESTAMP", "array<int>": "INTEGER[]", "array<string>": "VARCHAR[]",
}


def compare(spark, connection, sf_dir, key, function, sql):
    df = function(spark, sf_dir)
    names, rows = spark_rows(df)
    other_names, other_rows, types = duck_rows(connection, sql)
    for name, kind in df.dtypes:
        if name in types and SQL_TYPES.get(kind) != types[name]:
            print(f"  type of {key}.{name}: {kind} vs {types[name]}")
    if names != other_names:
        return f"{key}: columns differ {set(names) ^ set(other_names)}"
    if rows != other_rows:
        missing = [r for r in rows if r not in set(other_rows)][:3]
        extra = [r for r in other_rows if r not in set(rows)][:3]
        return (
            f"{key}: {len(rows)} vs {len(other_rows)} rows; columns {names}\n"
            f"  only Spark {missing}\n  only SQL {extra}"
        )
    return None


def main(sf="0.01", *keys):
    import __spark_entry__ as entry
    from gridledger.session import local_session

    sf_dir = f"/root/testdata/sf{sf}"
    spark, connection = local_session(8), duck(sf_dir)
    sql = entry.oracle_sql()
    bad = 0
    for key, function in entry.queries().items():
        if keys and key not in keys:
            continue
        start = time.time()
        try:
            if key in sql:
                problem = compare(spark, connection, sf_dir, key, function, sql[key])
                note = "same"
            else:
                names, rows = spark_rows(function(spark, sf_dir))
                problem, note = None, f"no SQL, {len(rows)} rows"
        except Exception as error:  # shown, then the next query runs
            problem = f"{key}: {type(error).__name__} {str(error)[:1500]}"
        bad += problem is not None
        print(problem or f"{key}: {note}", f"({time.time() - start:.1f}s)", flush=True)
    print("problems:", bad)


if __name__ == "__main__":
    main(*sys.argv[1:])
