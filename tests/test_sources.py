import gzip
from datetime import date

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ledgerline.sources import datasets, manifests


@pytest.fixture
def root(spark, tmp_path):
    root = f"file://{tmp_path}/docs"
    for day, shard, rows in (("2024-01-01", "0001", [("b", 2), ("a", 1)]), ("2024-01-05", "0002", [("c", 3)]), ("2024-02-01", "0001", [("d", 4)])):
        datasets.write_partition(spark.createDataFrame(rows, "acc string, n int"), root, f"date={day}/cik_shard={shard}", ["acc"])
    return root


def test_partitions_are_listed_pruned_and_counted(spark, root):
    window = datasets.files_between(spark, root, date(2024, 1, 1), date(2024, 1, 5))
    assert [datasets.partition_of(p)["date"] for p in window] == ["2024-01-01", "2024-01-05"] and len(datasets.files_between(spark, root)) == 3
    assert len(datasets.partition_files(spark, root, "cik_shard=0001")) == 2 and datasets.partition_files(spark, root, "cik_shard=000") == []
    assert datasets.footer_rows(spark, root) == 4 and datasets.footer_rows(spark, root + "/none") == 0
    rows = spark.read.parquet(window[0]).select("acc", datasets.partition_column(F.col("_metadata.file_path"), "date").alias("day")).collect()
    assert [tuple(r) for r in rows] == [("a", "2024-01-01"), ("b", "2024-01-01")]
    assert datasets.partition_of("x/docs/month=2024-01/part-0000.parquet") == {"dataset": "docs", "month": "2024-01"} and datasets.partition_of("x.parquet") is None
    datasets.copy_file(spark, window[0], f"{root}/date=2024-01-01/extra.parquet")
    with pytest.raises(datasets.StrayFileError):
        datasets.files_between(spark, root)


def test_a_rewritten_partition_has_one_file(spark, root):
    path = datasets.write_partition(spark.createDataFrame([("z", 9)], "acc string, n int"), root, "date=2024-01-01/cik_shard=0001", ["acc"])
    assert [tuple(r) for r in spark.read.parquet(path).collect()] == [("z", 9)] and len(datasets.partition_files(spark, root)) == 3


def test_reads_fill_unite_and_filter(spark, root, tmp_path):
    schema = StructType.fromDDL("acc string, gone string")
    assert [tuple(r) for r in datasets.read_table(spark, datasets.partition_files(spark, root)[0], schema).collect()] == [("a", None), ("b", None)]
    assert datasets.read_table(spark, f"{root}/none", schema).count() == 0
    paths = datasets.partition_files(spark, root)
    assert {r.acc for r in datasets.read_files(spark, paths, ["acc", "no"], {"acc": ["a", "d", "q"]}).collect()} == {"a", "d"}
    assert datasets.read_files(spark, paths, where={"no": ["x"]}).count() == 0 and datasets.read_files(spark, []) is None
    other = f"file://{tmp_path}/other"
    spark.createDataFrame([("e", "five")], "acc string, n string").coalesce(1).write.parquet(other)
    mixed = datasets.read_files(spark, [*paths, other], ["acc", "n"])
    assert {tuple(r) for r in mixed.collect()} == {("a", "1"), ("b", "2"), ("c", "3"), ("d", "4"), ("e", "five")}


def test_stored_texts(spark, tmp_path):
    (tmp_path / "a.txt").write_bytes(b"plain \xff")
    (tmp_path / "b.gz").write_bytes(gzip.compress("zipped é".encode()))
    stored = datasets.documents_at(spark, [str(tmp_path / "a.txt"), str(tmp_path / "b.gz")])
    assert sorted(r.text for r in stored.collect()) == ["plain �", "zipped é"]
    uri = [r.resource_uri for r in stored.collect() if r.text.startswith("zip")][0]
    rows = spark.createDataFrame([(1, "own", uri), (2, " ", uri), (3, None, "gone")], "k int, text string, resource_uri string")
    assert {r.k: r.text for r in datasets.resolved_texts(rows, stored).collect()} == {1: "own", 2: "zipped é", 3: None}
    assert datasets.split_uri("s3://b/k/x") == ("b", "k/x") and datasets.joined("s3://b/", "/x/", "y") == "s3://b/x/y"
    with pytest.raises(ValueError):
        datasets.split_uri("/local")
    (tmp_path / "list").write_text("# some\n320193\n\n0000320193\n")
    assert [r.cik for r in datasets.listed_issuers(spark, str(tmp_path / "list")).collect()] == ["0000320193"]
    (tmp_path / "every").write_text("all\n")
    assert datasets.listed_issuers(spark, str(tmp_path / "every")) is None


def test_filings_and_their_candidates(spark):
    doc = lambda seq, kind, key, name=None, text=None: f'{{"seq": {seq}, "type": "{kind}", "filename": "{name or key}", "s3_key": "{key}", "description": "{text or ""}"}}'
    two = f"[{doc(2, 'EX-99', 'k2', 'b.htm')}, {doc(1, '6-K', 'k1', 'a.htm')}, {doc('null', 'PDF', 'k3', 'c.pdf')}]"
    whole = f"[{doc(1, '8-K', 'k1')}, {doc(2, 'x', 'k9', None, 'Complete submission text file')}]"
    rows = [
        ("p/2024-01-01/6-K/320193/a1/manifest.json", "320193", "a-1", "6-K", "2024-01-01", "2024-01-02 00:00:00", "Acme", None, two), ("p/2024-01-01/6-K/320193/a1/manifest.json", "320193", "a-1", "6-K", "2024-01-01", "2024-01-01 00:00:00", "Old", None, "[]"),
        ("p/2024-01-03/8-K/1/a2/manifest.json", "1", "a-2", "8-K", "2024-01-03", "2024-01-04 00:00:00", "B", None, whole), ("p/2024-01-03/8-K/1/a3/manifest.json", "1", "a-3", "8-K", "2024-01-03", "2024-01-04 00:00:00", "B", "HTTP 500", whole),
        ("p/2024-01-04/8-K/1/a4/manifest.json", "1", "a-4", "8-K", "soon", "2024-01-04 00:00:00", "B", "", "{"),
    ]
    names = "manifest_key string, cik string, accession_number string, form_type string, filing_date string, last_scraped_at string, company_name string, failure_reason string, documents_json string"
    table = spark.createDataFrame(rows, names)
    known = manifests.filings(table)
    assert {r.accession_number: r.problem for r in known.collect()} == {"a1": None, "a2": None, "a4": "no date"}
    ciks = spark.createDataFrame([("0000320193",)], "cik string")
    assert [r.company_name for r in manifests.filings(table, "2024-01-01", "2024-01-02", ["6-K"], ciks).collect()] == ["Acme"]
    assert {r.accession_number: (r.resource, r.failure) for r in manifests.submission_candidates(known).collect()} == {"a1": (None, "no complete submission"), "a2": ("k9", None), "a4": (None, "no date")}
    stored = lambda *texts: spark.createDataFrame(list(texts), "s3_key string, text string")
    one = manifests.filings(table, forms=["6-K"])
    build = lambda *texts: tuple(manifests.assembled_submissions(one, stored(*texts)).first())[2:]
    assert build(("k1", "<DOCUMENT>1"), ("k2", " <DOCUMENT>2"), ("k3", "%PDF")) == ("<DOCUMENT>1 <DOCUMENT>2", 1, None)
    assert build(("k1", "bare"), ("k2", "<DOCUMENT>2"), ("k3", "%PDF"))[::2] == (None, "malformed document")
    assert build(("k1", "<DOCUMENT>1"), ("k3", "%PDF"))[::2] == (None, "document not found")
