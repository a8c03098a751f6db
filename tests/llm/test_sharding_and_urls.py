import random
import re
from collections import defaultdict
from hashlib import md5

from matchweave.llm.sharding import assign_shards, write_shards
from matchweave.llm.url_filter import RULES, SITES, UNWANTED, judge_urls, word_rule
from tests.llm.data import frame


def plain_shards(rows, limit):
    bits = {i: format(int(md5(str(i).encode()).hexdigest()[:10], 16), "040b") for i, _ in rows}
    sizes = [(i, len((t or "").encode())) for i, t in rows]
    out = {}

    def split(prefix, inside):
        if sum(n for _, n in inside) <= limit or len(inside) == 1:
            out.update({i: (prefix, sum(n for _, n in inside), len(inside)) for i, _ in inside})
        else:
            for bit in "01":
                part = [x for x in inside if bits[x[0]][len(prefix)] == bit]
                split(prefix + bit, part)

    split("", sizes)
    return out


def test_shards_equal_splitting_by_hand(spark, tmp_path):
    random.seed(1)
    rows = [(i, random.choice([None, "", "é" * random.randrange(50)])) for i in range(300)] + [(1000, "x" * 900)]
    docs = frame(spark, rows, "doc_id bigint, text string", extra=True)
    for limit, bits in ((400, 3), (400, 12), (10**6, 12)):
        got = assign_shards(docs, limit, round_bits=bits)
        wanted = plain_shards(rows, limit)
        assert {r.doc_id: (r.shard, r.shard_bytes, r.shard_docs) for r in got.collect()} == wanted
        assert all(r.depth == len(r.shard) for r in got.collect())
    write_shards(docs.select("doc_id", "text"), assign_shards(docs, 400), str(tmp_path / "out"))
    assert spark.read.parquet(str(tmp_path / "out")).count() == len(rows)


def test_rows_of_one_key_split_too(spark):
    docs = frame(spark, [(7, "x" * 100)] * 40 + [(None, "y")] * 3, "doc_id bigint, text string")
    got = assign_shards(docs, 400).collect()
    sizes = defaultdict(int)
    for r in got:
        sizes[r.shard] += r.n_bytes
    assert len(got) == 43 and max(sizes.values()) <= 400
    assert assign_shards(docs.limit(0), 400).count() == 0


def plain_verdict(url):
    rest = url.partition("://")[2] if url and "://" in url else ""
    host = re.match(r"[^/?#]*", rest)[0]
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    path = re.match(r"[^?#]*", rest[len(host) :])[0]
    best = None
    for verdict, site in SITES:
        rule_host, _, rule_path = site.partition("/")
        if (host == rule_host or host.endswith("." + rule_host)) and path.startswith("/" + rule_path):
            best = max(best or (0, "", ""), (len(site), site, verdict))
    if best:
        return host, path, best[1], best[2]
    words = re.findall("[a-z0-9]+", "".join(c.lower() if c < "\x80" else c for c in host + "/" + path))
    return host, path, None, "block" if set(words) & set(UNWANTED) else "allow"


def test_verdicts_equal_all_rules(spark):
    random.seed(2)
    urls = [None, "", "no scheme", "http://", "http://com", "http://com/", "x://A.Example.COM/en/1?q#f", "http://a.net/es", "http://a.net/es/"]
    urls += ["http://notexample.com/en/", "http://www.example.com/en/x", "http://x.org/Casino", "http://casino.org", "a://b://c.net/fr/x", "http://a.com?/x"]
    for _ in range(400):
        host = ".".join(random.choice(["www", "example", "com", "net", "adult-x", "ORG", "poker"]) for _ in range(random.randrange(1, 4)))
        path = "/".join(random.choice(["", "en", "es", "fr", "bet-1", "x"]) for _ in range(random.randrange(4)))
        urls.append(f"https://{host}{random.choice(['', '/', '?', '#'])}{path}")
    pages = frame(spark, [(i, u) for i, u in enumerate(urls + urls[:9])], "page_id bigint, url string")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in judge_urls(pages).collect()}
    assert got == {i: plain_verdict(u) for i, u in enumerate(urls + urls[:9])}
    assert judge_urls(pages.limit(0)).count() == 0
    few = judge_urls(pages, rules=(word_rule("poker"),), default="unknown").filter("verdict = 'block'").count()
    words = [re.findall("[a-z0-9]+", (plain_verdict(u)[0] + "/" + plain_verdict(u)[1]).lower()) for u in urls + urls[:9]]
    assert few == sum("poker" in w for w in words)
    assert all(r.tokens for r in RULES)
