import random
import re

from pyspark.sql import functions as F

from matchweave.functions import text as X
from matchweave.plans.matching import keyword_map, with_keywords


def values(spark, rows, expression):
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], "i int, t string")
    return [r.v for r in df.select("i", expression(F.col("t")).alias("v")).orderBy("i").collect()]


def test_names(spark):
    rows = ["Ala Test — Dev\nmore", "Ala Test", "A-B — C", " \n\t Ola Nowak – Ops", "", "  ", " Jan  - x"]
    assert values(spark, rows, X.extract_name) == ["Ala Test", "Ala Test", "A", "Ola Nowak", None, None, "Jan"]


def test_titles(spark):
    rows = ["Stanowisko:  Lead — Dev \nx", "Lead - Dev", "Stanowisko: \nnext", "x Stanowisko: y"]
    assert values(spark, rows, X.extract_title) == ["Lead — Dev", "Lead - Dev", "Stanowisko:", "x Stanowisko: y"]
    assert values(spark, ["Role: Chef"], lambda c: X.extract_title(c, "Role:")) == ["Chef"]


def test_first_line_and_task(spark):
    assert values(spark, ["a\r\nb", "\nb", "a\x0bb", ""], X.first_line) == ["a", "", "a", None]
    assert values(spark, ["hi"], lambda c: X.task_text(c, "search_query")) == ["search_query: hi"]


def test_tokens(spark):
    rows = ["Zażółć CI/CD, x_1 — C++", ""]
    assert values(spark, rows, X.tokens) == [["zażółć", "ci", "cd", "x_1", "c"], []]


def test_keywords(spark):
    offers = spark.createDataFrame([("devops_engineer",), ("data_lead",)], "filename string")
    got = {r.filename: r.keywords for r in with_keywords(offers, keyword_map(spark, {"devops_engineer": "Kubernetes Terraform"})).collect()}
    assert got["data_lead"] == "data lead"
    assert got["devops_engineer"].startswith("Kubernetes Terraform")


def test_names_of_texts_with_blanks_and_line_ends_of_any_kind(spark):
    rng, pieces = random.Random(3), ["", " ", "\t", "\n", "\r\n", "\x0b", "\x1f", "\x85", "\xa0", " ", "a", "Bo é", "-", " — ", "Stanowisko:", "x😀"]
    texts = ["".join(rng.choice(pieces) for _ in range(rng.randint(0, 7))) for _ in range(3_000)]
    df = spark.createDataFrame([(t,) for t in [*texts, None]], "t string")
    got = df.select("t", X.extract_name(F.col("t")).alias("name"), X.extract_title(F.col("t")).alias("title")).collect()

    def head(text, pattern):
        lines = text.strip().splitlines()
        if not lines:
            return None
        found = re.search(pattern, lines[0])
        return (found[1] if found else lines[0]).strip()

    for r in got:
        name = None if r.t is None else head(r.t, r"^(.+?)\s*[—–-]")
        title = None if r.t is None else head(r.t, r"^Stanowisko:\s*(.+)")
        assert (r.name, r.title) == (name, title or name), repr(r.t)

