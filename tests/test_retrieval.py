import random

import pytest

from matchweave.operators import fulltext as T
from matchweave.operators import fusion, quality
from matchweave.operators.vector_search import vector_search


def frames(spark, docs, queries):
    return (
        spark.createDataFrame(docs, "id long, raw_text string"),
        spark.createDataFrame(queries, "query_id long, keywords string"),
    )


def plain_cover_density(words, wanted):
    """Minimal covers found by trying every span."""
    spots = [(i, w) for i, w in enumerate(words, 1) if w in wanted]
    covers = []
    for a in range(len(spots)):
        for b in range(a, len(spots)):
            if {w for _, w in spots[a : b + 1]} == wanted:
                covers.append((a, b))
                break
    minimal = [c for c in covers if not any(d != c and d[0] >= c[0] and d[1] <= c[1] for d in covers)]
    return sum(0.1 / (1 + (spots[b][0] - spots[a][0]) - (b - a)) for a, b in minimal)


def test_goldens(spark):
    docs, queries = frames(
        spark, [(1, "a x b a"), (2, "a a a"), (3, "b c"), (4, "")], [(1, "a b"), (2, "A a"), (3, "zz a"), (4, "  ,")]
    )
    got = {(r.query_id, r.id): round(r.score, 9) for r in T.fulltext_scores(T.query_terms(queries), T.postings(docs)).collect()}
    assert got == {(1, 1): 0.15, (2, 1): 0.2, (2, 2): 0.3}


@pytest.mark.parametrize("options", [{}, {"small": False, "slice_rows": 20}])
def test_random_texts(spark, options):
    rng = random.Random(9)
    docs = [(i, " ".join(rng.choices("a b c d e the the the".split(), k=rng.randint(0, 25)))) for i in range(60)]
    queries = [(1, "the"), (2, "a b"), (3, "the c d"), (4, "a b c d e"), (5, "nope the")]
    d, q = frames(spark, docs, queries)
    got = {(r.query_id, r.id): r.score for r in T.fulltext_scores(T.query_terms(q), T.postings(d), **options).collect()}
    want = {}
    for query_id, words in queries:
        for i, text in docs:
            if set(words.split()) <= set(text.split()):
                want[(query_id, i)] = plain_cover_density(text.split(), set(words.split()))
    assert got == pytest.approx(want)


def test_a_rare_word_leads_whatever_its_length(spark):
    rng = random.Random(2)
    docs = [(i, "extraordinarily common " + " ".join(rng.choices("a b c d".split(), k=6)) + (" q" if i % 100 == 0 else "")) for i in range(1_000)]
    d, q = frames(spark, docs, [(1, "extraordinarily q"), (2, "common extraordinarily"), (3, "q nowhere"), (4, "")])
    terms, posts = T.query_terms(q), T.postings(d)
    places = T.term_places(terms, posts, True)
    leads = T.leading_terms(terms, places)
    assert {r.query_id: r.lead for r in leads.collect()} == {1: "q", 2: "common"}
    met = {r.query_id: r["count"] for r in T.candidate_pairs(leads, places, True).groupBy("query_id").count().collect()}
    assert met == {1: 10, 2: 1_000}  # of the common long word nothing but the rare word's documents
    thin = [f.name for f in T.candidate_pairs(leads, places, False, 50).schema.fields]
    assert sorted(thin) == ["id", "lead", "query_id", "terms"]  # no places
    assert T.fulltext_match(terms, posts).count() == 1_010


def test_reciprocal_rank_goldens(spark):
    hit = "query_id long, id long, score double, rank long"
    vec = spark.createDataFrame([(1, 10, 0.9, 1), (1, 11, 0.8, 2)], hit)
    text = spark.createDataFrame([(1, 11, 0.5, 1), (2, 12, 0.5, 1)], hit)
    got = {(r.query_id, r.id): round(r.rrf_score, 6) for r in fusion.fuse(vec, text).collect()}
    assert got == {(1, 10): 0.016393, (1, 11): 0.032522, (2, 12): 0.016393}


@pytest.fixture(scope="module")
def corpus(spark):
    rows = [
        (1, "a", "Ann", "python react", [1.0, 0.1]),
        (2, "b", "Jan", "python fastapi docker", [1.0, 0.2]),
        (3, "c", "Ewa", "java", None),
        (4, "d", "Ola", "fastapi python", None),
    ]
    table = spark.createDataFrame(rows, "id long, filename string, title string, raw_text string, embedding array<float>")
    return fusion.Corpus.of(table)


def test_hybrid_turns_the_vector_order(spark, corpus):
    queries = spark.createDataFrame([(7, [1.0, 0.0], "Python FastAPI")], "query_id long, embedding array<float>, keywords string")
    assert [r.id for r in vector_search(queries, corpus.vectors, 2, 2).orderBy("rank").collect()] == [1, 2]
    hits = fusion.hybrid_search(queries, corpus, 2, k=3).orderBy("rank").collect()
    # Both texts hold the words side by side and tie; documents without a vector come last by vector.
    assert [(r.id, r.name, r.vec_rank, r.text_rank) for r in hits] == [(2, "Jan", 2, 1), (4, "Ola", 4, 2), (1, "Ann", 1, None)]
    assert next(r for r in hits if r.id == 4).vec_score is None


def test_quality(spark):
    hits = spark.createDataFrame([(1, 5, 1), (2, 6, 1), (2, 7, 2)], "query_id long, id long, rank long")
    expected = spark.createDataFrame([(1, 5), (2, 7), (3, 9)], "query_id long, expected_id long")
    per_query = quality.rank_quality(hits, expected, 2)
    got = {r.query_id: (r.hit_at_1, r.hit_at_k, r.reciprocal_rank) for r in per_query.collect()}
    assert got == {1: (1, 1, 1.0), 2: (0, 1, 0.5), 3: (0, 0, 0.0)}
    assert quality.quality_summary(per_query).first().mrr == pytest.approx(0.5)
