"""SimHash against brute force over all pairs."""

import random

import numpy as np
import pytest
import xxhash

from parcelle.llm import simhash


def brute_fp(text, k=4):
    words = (text or "").encode().lower().split()
    grams = [b" ".join(words[i:i + k]) for i in range(len(words) - k + 1)] or ([b" ".join(words)] if words else [])
    h = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if sum(x >> b & 1 for x in h) * 2 > len(h))


def brute_components(rows, radius):
    fps = [brute_fp(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i
    for i in range(len(rows)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= radius:
                parent[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(least.get(find(i), d), d)
    return sorted(((d, f"{fps[i]:016x}", least.get(find(i))) for i, (d, _) in enumerate(rows)), key=str)


def make_rows(seed=1):
    r = random.Random(seed)
    vocab = [f"w{i}" for i in range(400)]
    rows = []
    for i in range(60):
        base = r.choices(vocab, k=r.choice([3, 8, 120, 400]))
        rows.append((10 * i, " ".join(base)))
        for j in range(r.choice([0, 1, 3])):
            new = list(base)
            new[r.randrange(len(new))] = "x"
            rows.append((10 * i + j + 1, "\n".join(new) if j else " ".join(new).upper()))
    rows += [(900, None), (901, ""), (None, rows[0][1]), (902, " \t"), rows[4], rows[4], (None, "only one null id here"), (903, "é É ü")]
    return rows


@pytest.mark.parametrize("radius", [0, 1, 3, 4, 7])
def test_bit_sliced_distance_equals_popcount(radius):
    r = np.random.default_rng(radius)
    fp = r.integers(0, 2**63, 200, dtype=np.uint64)
    fp[100:] = fp[:100] ^ (np.uint64(1) << r.integers(0, 64, 100, dtype=np.uint64)) ^ (r.integers(0, 16, 100, dtype=np.uint64))
    run = np.zeros(200, int)
    root = simhash.forest(fp, run, np.zeros(200, int), radius)
    near = np.bitwise_count(fp[:, None] ^ fp[None, :]) <= radius
    reach = near
    for _ in range(8):
        reach = (reach.astype(int) @ reach.astype(int)) > 0
    assert (reach == (root[:, None] == root[None, :])).all()


@pytest.mark.parametrize("block", [2048, 4])
def test_components_equal_brute_force(spark, block, monkeypatch):
    real = simhash.links
    monkeypatch.setattr(simhash, "links", lambda f, r: real(f, r, block_rows=block))
    rows = make_rows()
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("doc_id", "text", "'e' fp", "1 AS root")
    got = sorted(map(tuple, simhash.simhash_components(df).collect()), key=str)
    assert got == brute_components(rows, 4)


def test_dedup_keeps_one_of_each_group_and_the_columns(spark):
    rows = make_rows(2)
    df = spark.createDataFrame([(d, t, "s") for d, t in rows], "doc_id long, text string, root string")
    kept = simhash.simhash_dedup(df).collect()
    groups = {(c, None) if c is not None else (None, f) for _, f, c in brute_components(rows, 4)}
    assert len(kept) == len(groups) and kept[0].asDict().keys() == {"doc_id", "text", "root"}
    assert {k.doc_id for k in kept if k.doc_id is not None} == {c for c, _ in groups if c is not None}


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert simhash.simhash_components(df).count() == 0 and simhash.simhash_dedup(df).count() == 0


def test_one_band_with_a_third_of_the_fingerprints_is_cut_into_small_groups(spark, monkeypatch):
    """A hot band value: all links are found, and the groups stay near the size asked for."""
    import numpy as np
    r = np.random.default_rng(4)
    n = 3000
    fp = r.integers(0, 2**63, n, dtype=np.int64)
    fp[: n // 3] = (fp[: n // 3] >> 12) << 12  # one value of the first band
    fp[1] = fp[0] ^ (1 << 40)
    df = spark.createDataFrame([(int(x),) for x in np.unique(fp)], "fp long")
    sizes, frame = [], type(df)
    real = frame.groupBy

    def spy(self, *cols):
        if cols == ("_g",):
            sizes.extend(x["count"] for x in real(self, "_g").count().collect())
        return real(self, *cols)
    monkeypatch.setattr(frame, "groupBy", spy)
    edges = simhash.links(df, 4, block_rows=50, rows_per_task=500).collect()
    assert {frozenset((int(fp[0]), int(fp[1])))} <= {frozenset((e.a, e.b)) for e in edges}
    assert max(sizes) < 5 * 500 and sum(sizes) > n * 5
