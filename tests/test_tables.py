import os
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from matchweave.operators.inference import hashed_embedding, shared_word_scorer
from matchweave.plans.matching import keyword_map, match_offers
from matchweave.session import scratch_path
from matchweave.sources import files, tables
from matchweave.streaming import ingest
from matchweave.streaming.ingest import ingest_new_files

DIM = 16
MODEL = hashed_embedding(DIM)


@pytest.fixture()
def stored(spark):
    tables.drop_tables(spark)
    tables.create_tables(spark, buckets=5)
    tables.create_tables(spark)
    yield spark
    tables.drop_tables(spark)
    assert not spark.catalog.tableExists("cvs")


def rows(df):
    return sorted((r.id, r.filename, r.title, r.raw_text) for r in df.collect())


def test_text_files(spark, tmp_path):
    (tmp_path / "b +ó.txt").write_text("Bo\nline", encoding="utf-8")
    (tmp_path / "a%20x.txt").write_text("\nA", encoding="utf-8")
    (tmp_path / "c.md").write_text("no")
    docs = files.read_text_files(spark, str(tmp_path))
    assert {r.filename: r.raw_text for r in docs.collect()} == {"b +ó": "Bo\nline", "a%20x": "\nA"}
    assert [r.first_line for r in files.list_candidates(docs).collect()] == ["", "Bo"]
    empty = tmp_path / "empty"
    empty.mkdir()
    assert files.read_text_files(spark, str(empty)).count() == 0


def test_bootstrap_upsert_and_match(stored, tmp_path):
    spark = stored
    people, jobs = tmp_path / "people", tmp_path / "jobs"
    people.mkdir(), jobs.mkdir()
    (people / "jan.txt").write_text("Jan — Dev\nPython Docker", encoding="utf-8")
    (people / "ola.txt").write_text("Ola — Ops\nJava", encoding="utf-8")
    (jobs / "python_dev.txt").write_text("Stanowisko: Python Dev\nPython Docker", encoding="utf-8")
    stats = tables.bootstrap(spark, {"cvs": str(people), "job_offers": str(jobs)}, MODEL, DIM)
    assert {r.table_name: r.n for r in stats.collect()} == {"cvs": 2, "job_offers": 1}
    assert spark.table("job_offers").first().title == "Python Dev"
    first = {r.filename: (r.id, r.created_at) for r in spark.table("cvs").collect()}
    assert {k: v[0] for k, v in first.items()} == {"jan": 1, "ola": 2}

    (people / "ala.txt").write_text("Ala - QA\nKotlin", encoding="utf-8")
    (people / "ola.txt").write_text("Ola — Lead\nScala Java", encoding="utf-8")
    got = [(r.filename, r.id) for r in tables.ingest_folder(spark, str(people), "cvs", MODEL, DIM).collect()]
    assert got == [("ala", 3), ("jan", 1), ("ola", 2)]
    after = {r.filename: r for r in spark.table("cvs").collect()}
    assert after["ola"].raw_text.endswith("Scala Java") and after["ola"].created_at == first["ola"][1]
    posts = tables.read_postings(spark, "cvs")
    assert sorted(r.term for r in posts.filter("id = 2").collect()) == ["java", "lead", "ola", "scala"]
    before = rows(spark.table("cvs"))
    tables.ingest_folder(spark, str(people), "cvs", MODEL, DIM)
    assert rows(spark.table("cvs")) == before

    wanted = spark.createDataFrame([("python_dev",), ("nope",)], "filename string")
    found = match_offers(
        wanted, spark.table("job_offers"), spark.table("cvs"), keyword_map(spark, {"python_dev": "python"}), MODEL, shared_word_scorer, DIM, posts=posts
    )
    assert [r.filename for r in found.unmatched.collect()] == ["nope"]
    assert "#1  jan" in found.reports.first().report
    assert "candidate_name" in tables.read_documents(spark, "cvs").columns


def test_last_write_wins_and_dimension_is_checked(stored):
    spark = stored
    vector = F.array(*[F.lit(float(i)) for i in range(DIM)]).cast("array<float>")
    data = [("f", "t1", "one", 1), ("f", "t3", "three", 3), ("f", "t2", "two", 2), ("a", "x", "y", 9)]
    batch = spark.createDataFrame(data, "filename string, title string, raw_text string, seq long").withColumn("embedding", vector)
    tables.upsert(spark, "cvs", batch, DIM, datetime(2024, 1, 1))
    assert rows(spark.table("cvs")) == [(1, "f", "t3", "three"), (2, "a", "x", "y")]
    with pytest.raises(Exception, match="expected 16 dimensions"):
        tables.upsert(spark, "cvs", batch.withColumn("embedding", F.slice("embedding", 1, 3)), DIM)


def test_new_files_arrive(stored, tmp_path):
    spark, progress = stored, scratch_path(stored, "progress")
    (tmp_path / "a.txt").write_text("A - x")
    ingest_new_files(spark, str(tmp_path), "cvs", MODEL, DIM, progress).awaitTermination()
    (tmp_path / "b.txt").write_text("B - y")
    ingest_new_files(spark, str(tmp_path), "cvs", MODEL, DIM, progress).awaitTermination()
    assert rows(spark.table("cvs")) == [(1, "a", "A", "A - x"), (2, "b", "B", "B - y")]


def test_changed_files_are_taken_again(stored, tmp_path):
    spark, folder, ledger = stored, tmp_path / "files", str(tmp_path / "ledger")
    folder.mkdir()

    def run(**options):
        return ingest.ingest_changed_files(spark, str(folder), "cvs", MODEL, DIM, ledger, **options)

    assert run() == 0
    for name in ("a", "b", "c"):
        (folder / f"{name}.txt").write_text(f"{name.upper()} - x")
    (folder / "d.md").write_text("no")
    assert run(files_per_batch=2) == 3 and run() == 0
    assert rows(spark.table("cvs"))[0] == (1, "a", "A", "A - x") and spark.table("cvs").count() == 3
    (folder / "b.txt").write_text("Ben — changed")
    (folder / "e.txt").write_text("Eva\n- new")
    (folder / "c.txt").unlink()
    assert run() == 2 and run() == 0
    assert {r.filename: r.title for r in spark.table("cvs").collect()} == {"a": "A", "b": "Ben", "c": "C", "e": "Eva"}


def test_text_files_are_written_as_they_are(spark, tmp_path):
    texts = [("a b+ó", "Zeile\r\nzwei ✓ "), ("empty", ""), ("none", None), ("a%20x", "x")]
    df = spark.createDataFrame(texts, "filename string, raw_text string").repartition(3)
    assert files.write_text_files(df, str(tmp_path / "new")).agg(F.sum("n_files")).first()[0] == 3
    got = {r.filename: r.raw_text for r in files.read_text_files(spark, str(tmp_path / "new")).collect()}
    assert got == {k: v for k, v in texts if v}  # Spark's readers skip empty files


def test_emptied_texts_leave_the_index(stored):
    spark = stored
    vector = F.lit(None).cast("array<float>").alias("embedding")
    batch = spark.createDataFrame([("a", "t", "kubernetes terraform", 1)], "filename string, title string, raw_text string, seq long")
    tables.upsert(spark, "cvs", batch.withColumn("embedding", vector), DIM)
    assert sorted(r.term for r in tables.read_postings(spark, "cvs").collect()) == ["kubernetes", "terraform"]
    tables.upsert(spark, "cvs", batch.withColumn("raw_text", F.lit("---")).withColumn("embedding", vector), DIM)
    assert tables.read_postings(spark, "cvs").count() == 0


def test_small_files_are_read_by_few_tasks(spark, tmp_path):
    texts = spark.range(3_000).selectExpr("concat('a b+%20_', id) AS filename", "concat('Jan ', id, ' - x') AS raw_text")
    files.write_text_files(texts, str(tmp_path / "in")).collect()
    read = files.read_text_files(spark, str(tmp_path / "in"))
    listed = files.list_text_files(spark, str(tmp_path / "in"))
    assert max(read.rdd.getNumPartitions(), listed.rdd.getNumPartitions()) <= 2 * spark.sparkContext.defaultParallelism
    assert sorted(map(tuple, read.select("filename", "raw_text").collect())) == sorted(map(tuple, texts.collect()))
    again = files.read_listed_files(spark, str(tmp_path / "in"), listed)
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, read.collect()))


def test_a_run_upserts_once(stored, tmp_path, monkeypatch):
    calls, whole = [], ingest.upsert
    monkeypatch.setattr(ingest, "upsert", lambda *args: calls.append(1) or whole(*args))
    texts = stored.range(10_050).selectExpr("concat('f', id) AS filename", "concat('Jan ', id) AS raw_text")
    files.write_text_files(texts, str(tmp_path / "in")).collect()
    assert ingest.ingest_changed_files(stored, str(tmp_path / "in"), "cvs", MODEL, DIM, str(tmp_path / "ledger")) == 10_050
    assert len(calls) == 1 and stored.table("cvs").count() == 10_050


def test_postings_are_sorted_where_the_texts_are_read(stored, monkeypatch):
    plans, whole = {}, tables._replace

    def replace(rows, table, order):
        plans[table] = rows._jdf.queryExecution().optimizedPlan().toString()
        whole(rows, table, order)

    monkeypatch.setattr(tables, "_replace", replace)
    batch = stored.range(40).selectExpr("concat('f', id) AS filename", "'t' AS title", "concat('word', id, ' same') AS raw_text", "CAST(NULL AS array<float>) AS embedding", "id AS seq")
    tables.upsert(stored, "cvs", batch, DIM)
    assert "Rebalance" in plans["cvs"] and "Rebalance" not in plans["cvs_postings"]
    assert tables.read_postings(stored, "cvs").count() == 80


def odd_folder(top):
    """A folder with names of all kinds, and what is no text file in it."""
    folder = top / "f older%20#"
    folder.mkdir()
    for name in ("b +ó.txt", "a%20x.txt", "x:y.txt", "h#.txt", "_h=1.txt", "_h.txt", ".h.txt", "_metadata.txt", "c.md", "d.TXT"):
        (folder / name).write_text(f"Jan {name} — x", encoding="utf-8")
    (folder / "empty.txt").write_text("")
    (folder / "dir.txt").mkdir()
    (folder / "dir.txt" / "in.txt").write_text("x")
    (folder / "link.txt").symlink_to("c.md")
    (folder / "gone.txt").symlink_to("nothing")
    (folder / "loop.txt").symlink_to("loop.txt")
    with open(os.fsencode(folder) + b"/\xff.txt", "w") as file:
        file.write("x")
    os.utime(folder / "h#.txt", ns=(1, 1_700_000_000_123_456_789))
    return str(folder)


def by_spark(spark, folder):
    found = spark.read.format("binaryFile").option("pathGlobFilter", "*.txt").load(folder)
    return found.select("path", F.unix_micros("modificationTime").alias("modified"), F.col("length").alias("size"))


def test_the_driver_lists_no_files(spark, tmp_path):
    folder = odd_folder(tmp_path)
    listed = files.list_text_files(spark, folder)
    assert not listed.inputFiles()  # an index of files in the driver tells each of them
    got = sorted(map(tuple, listed.collect()))
    assert got == sorted(map(tuple, by_spark(spark, folder).collect()))
    assert [p.rsplit("/", 1)[-1] for p, _, _ in got] == ["_h=1.txt", "a%20x.txt", "b +ó.txt", "h#.txt", "link.txt", "x:y.txt"]
    again = files.read_listed_files(spark, folder, listed)
    assert {r.filename: r.seq for r in again.collect()}["h#"] == 1_700_000_000_123_000


def test_partitions_and_patterns_are_left_to_spark(spark, tmp_path):
    for k in (1, 2):
        (tmp_path / "parts" / f"k={k}").mkdir(parents=True)
        (tmp_path / "parts" / f"k={k}" / f"{k}.txt").write_text("x")
        (tmp_path / "some" / f"g{k}").mkdir(parents=True)
        (tmp_path / "some" / f"g{k}" / f"{k}.txt").write_text("x")
    for folder in ("parts", "some/g*", "some/g1/1.txt"):
        wanted = sorted(map(tuple, by_spark(spark, str(tmp_path / folder)).collect()))
        assert wanted and sorted(map(tuple, files.list_text_files(spark, str(tmp_path / folder)).collect())) == wanted
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        files.list_text_files(spark, str(tmp_path / "none"))


def test_text_files_are_read_without_a_list_in_the_driver(spark, tmp_path):
    folder = odd_folder(tmp_path)
    read = files.read_text_files(spark, folder)
    assert not [path for path in read.inputFiles() if path.endswith(".txt")]
    texts = {name: f"Jan {name}.txt — x" for name in ("b +ó", "a%20x", "x:y", "h#", "_h=1")}
    assert {r.filename: r.raw_text for r in read.collect()} == texts | {"link": "Jan c.md — x"}
    (tmp_path / f"{folder}/late.txt").write_text("later")
    assert read.count() == 6 and files.read_text_files(spark, folder).count() == 7
