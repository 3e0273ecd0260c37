"""Wide files in any column order, each once; what cannot be read is in the manifest."""

import gzip

from parcelle.schemas import TRANSACTION_COLUMNS
from parcelle.streaming.wide_landing import ingest_files, manifest, read_files_landed

NAMES = [n for n, _ in TRANSACTION_COLUMNS]


def put(base, year, dep, columns, rows):
    (base / str(year)).mkdir(parents=True, exist_ok=True)
    text = "\n".join([",".join(columns), *[",".join(str(r.get(c, "")) for c in columns) for r in rows]]) + "\n"
    (base / str(year) / f"{dep}.csv.gz").write_bytes(gzip.compress(text.encode()))


def test_files_of_any_header_land_once(spark, tmp_path):
    land, table, seen = tmp_path / "land", str(tmp_path / "t"), str(tmp_path / "seen")
    wide = [f"w{i}" for i in range(25)]
    put(land, 2020, "01", [*wide, *NAMES], [{"id_mutation": "a", "valeur_fonciere": 10, "longitude": "bad"}, {"id_mutation": "b", "valeur_fonciere": 11}])
    put(land, 2021, "2A", [*NAMES[::-1], *wide], [{"id_mutation": "c", "valeur_fonciere": 12, "longitude": 2.5}])
    put(land, 2021, "03", ["id_mutation", "w0"], [{"id_mutation": "d"}])
    cut = gzip.compress(b"id_mutation\n" + bytes(range(65, 90)) * 4000)
    (land / "2021" / "04.csv.gz").write_bytes(cut[:len(cut) // 2])
    (land / "2021" / "05.csv.gz").write_bytes(gzip.compress(b""))
    assert ingest_files(spark, str(land), table, seen, max_files_per_trigger=2) == 4
    assert ingest_files(spark, str(land), table, seen) == 0
    got = {r.id_mutation: r for r in read_files_landed(spark, table).collect()}
    assert set(got) == set("abcd") and got["a"].longitude is None and got["c"].longitude == 2.5 and got["c"].departement == "2A"
    assert (got["a"].year, got["a"].departement) == (2020, "01") and got["d"].valeur_fonciere is None and got["a"].row_seq < got["b"].row_seq
    log = {r.path.rsplit("/", 1)[1]: r for r in manifest(spark, table).collect()}
    assert len(log) == 5 and log["04.csv.gz"].error and log["04.csv.gz"].rows == 0 and log["01.csv.gz"].rows == 2 and log["05.csv.gz"].rows == 0
    put(land, 2022, "06", NAMES, [{"id_mutation": "e", "valeur_fonciere": 5}])
    assert ingest_files(spark, str(land), table, seen) == 1 and read_files_landed(spark, table).count() == 5


def test_rows_without_a_manifest_are_not_read(spark, tmp_path):
    land, table, seen = tmp_path / "land", str(tmp_path / "t"), str(tmp_path / "seen")
    put(land, 2020, "01", NAMES, [{"id_mutation": "a"}])
    ingest_files(spark, str(land), table, seen)
    spark.read.parquet(f"{table}/batch=0").write.partitionBy("year", "departement").parquet(f"{table}/batch=7")  # a batch that was killed before its manifest
    assert read_files_landed(spark, table).count() == 1


def test_nothing_landed(spark, tmp_path):
    (tmp_path / "land").mkdir()
    assert ingest_files(spark, str(tmp_path / "land"), str(tmp_path / "t"), str(tmp_path / "seen")) == 0
    assert read_files_landed(spark, str(tmp_path / "t")).count() == 0 and manifest(spark, str(tmp_path / "t")).count() == 0


def test_wide_rows_are_dealt_out_before_they_become_text(spark, tmp_path, monkeypatch):
    import datetime

    from parcelle.plans import queries
    d = str(tmp_path / "tables")
    day = datetime.datetime
    tables = {
        "customer": ([(1, 7), (2, 13)], "c_custkey long, c_nationkey int"),
        "part": ([(1, "house", 5), (2, "flat", 3)], "p_partkey long, p_type string, p_size int"),
        "orders": ([(1, 1, day(2019, 5, 4), 1e5), (2, 2, day(2020, 2, 1), 2e5)], "o_orderkey long, o_custkey long, o_orderdate timestamp, o_totalprice double"),
        "lineitem": ([(1, 1, 4, 1, 8.0), (1, 2, 3, 2, 9.0), (2, 1, 8, 1, 7.0)], "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double")}
    for name, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{d}/{name}.parquet")
    dealt, kind = [], type(spark.range(1))
    hint = kind.hint
    monkeypatch.setattr(kind, "hint", lambda self, name, *a: (dealt.append((name, dict(self.dtypes))), hint(self, name, *a))[1])
    got = queries.q_landing_wide(spark, d).collect()
    assert sorted((r.id_mutation, str(r.date_mutation), r.valeur_fonciere, r.year, r.departement) for r in got) == [
        ("1", "2019-05-04", 1e5, 2019, "07"), ("1", "2019-05-04", 1e5, 2019, "07"), ("2", "2020-02-01", 2e5, 2020, "13")]
    dealt = [types for name, types in dealt if name == "rebalance"]
    assert len(dealt) >= 2 and all(not any(c.startswith("autre") for c in types) and types["date_mutation"] == "date" for types in dealt)
