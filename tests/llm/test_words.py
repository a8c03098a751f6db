import numpy as np
import pyarrow as pa

from matchweave.llm.words import hash_ranges, sequence_hashes, split_words


def thue_morse(n):
    return np.array([bin(i).count("1") % 2 for i in range(n)])


def test_complementary_patterns_hash_apart():
    for n in (64, 1_024, 4_096):
        one = thue_morse(n)
        words = ["".join("ab"[i] for i in one), "".join("ba"[i] for i in one)]
        found = split_words(pa.array([f"x {w} y" for w in words])).hashes.reshape(2, 3)
        assert found[0, 0] == found[1, 0] and found[0, 1] != found[1, 1]
        two = np.random.default_rng(1).integers(0, 1 << 63, 2, dtype=np.uint64)
        runs = np.concatenate([two[one], two[1 - one]])
        alike = sequence_hashes(runs, np.array([0, n]), np.array([n, 2 * n]))
        assert alike[0] != alike[1]


def test_hashes_tell_words_and_sequences_apart():
    rng = np.random.default_rng(2)
    text = bytes(rng.choice(list(b"abAB "), 20_000)).decode()
    words = split_words(pa.array([text, "", None, "Z" * 3_000_000, text]), lower=True)
    named = {}
    for a, b, h in zip(words.starts, words.ends, words.hashes):
        assert named.setdefault(words.data[a:b].tobytes().lower(), h) == h
    assert len(set(named.values())) == len(named)
    some = rng.integers(0, 3, 300).astype(np.uint64)
    starts = rng.integers(0, 290, 2_000)
    ends = np.minimum(starts + rng.integers(1, 10, 2_000), 300)
    named = {}
    for a, b, h in zip(starts, ends, sequence_hashes(some, starts, ends)):
        assert named.setdefault(tuple(some[a:b]), h) == h
    assert len(set(named.values())) == len(named)
    assert len(sequence_hashes(some, starts[:0], ends[:0])) == 0
    data = np.frombuffer(b"abba", dtype=np.uint8)
    assert len(set(hash_ranges(data, np.array([0, 1, 3]), np.array([1, 3, 4])).tolist())) == 2
