"""Near copies of the stage against all pairs of texts by their five-word shingles."""

import random

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from posterion.llm import simhash


def brute_links(texts):
    """Pairs of different rows with a five-word resemblance of 0.8 or more."""
    sets = {}
    for i, t in texts.items():
        w = (t or "").lower().split()
        sets[i] = {tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))}
    ids = sorted(sets)
    return {(a, b) for n, a in enumerate(ids) for b in ids[n + 1:]
            if 5 * min(len(sets[a]), len(sets[b])) >= 4 * max(len(sets[a]), len(sets[b])) and 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b])}


def test_no_pair_of_near_copies_stays(spark, data):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "text").collect()}
    kept = {r.doc_id for r in simhash.deduplicated(spark.read.parquet(f"{data}/documents.parquet")).collect()}
    links = brute_links(texts)
    assert links and not [p for p in links if kept >= set(p)]
    assert kept == firsts(texts, links)


def firsts(texts, links):
    """The smallest id of each group of linked rows."""
    parent = {i: i for i in texts}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in sorted(links):
        a, b = sorted((find(a), find(b)))
        parent[b] = a
    return {find(i) for i in texts}


def test_chains_of_near_copies_are_one_group(spark):
    """Texts that drift: the first and the last share little, neighbours share 0.8 or more; some drift the other way."""
    r = random.Random(9)
    word = lambda: "".join(r.choice("abcdefghij") for _ in range(7))
    texts, number = {}, 0
    for chain in range(15):
        base = [word() for _ in range(200)]
        drift = [list(base)]
        for step in range(12):
            own = list(drift[r.randrange(len(drift))])
            at = r.randrange(0, 185)
            own[at:at + 12] = [word() for _ in range(12)]               # some 16 of 196 shingles change
            drift.append(own)
        for own in r.sample(drift, len(drift)):
            texts[number] = " ".join(own)
            number += 1
    links = brute_links(texts)
    kept = {k.doc_id for k in simhash.deduplicated(spark.createDataFrame(sorted(texts.items()), "doc_id long, text string")).collect()}
    assert kept == firsts(texts, links) and len(kept) < len(texts) / 3


def test_sketches_count_equal_places(spark):
    r = np.random.default_rng(1)
    rows = []
    for _ in range(200):
        a = r.integers(0, 1 << 63, 64, dtype=np.uint64)
        b = np.where(r.random(64) < .5, a, r.integers(0, 1 << 63, 64, dtype=np.uint64))
        rows.append((simhash.sketch(a), simhash.sketch(b), int((a.astype(np.uint8) == b.astype(np.uint8)).sum())))
    got = spark.createDataFrame(rows, "a array<bigint>, b array<bigint>, want int").select(simhash.agreeing(F.col("a"), F.col("b")).alias("got"), "want").collect()
    assert all(g.got == g.want for g in got)


def test_groups_of_near_copies_leave_one(spark):
    r = random.Random(4)
    word = lambda: "".join(r.choice("abcdefghij") for _ in range(7))
    rows, number = [], 0
    for group in range(12):
        base = [word() for _ in range(300)]
        for copy in range(8):
            own = list(base)
            for at in r.sample(range(300), 3 if copy else 0):          # three words of 300: resemblance with the first about 0.9
                own[at] = word()
            rows.append((number, group, " ".join(own)))
            number += 1
        rows.append((number, group, " ".join(base[:150] + [word() for _ in range(150)])))      # half of it: stays
        number += 1
    kept = simhash.deduplicated(spark.createDataFrame(rows, "doc_id long, g int, text string")).orderBy("doc_id").collect()
    assert [k.doc_id for k in kept] == [x for g in range(12) for x in (9 * g, 9 * g + 8)]
    assert simhash.resemblance("a b c d e f", "a b c d e g") == 1 / 3 and simhash.resemblance("A b", "a B") == 1


def mixed(h, salt):
    """splitmix64's finish in plain numbers."""
    x = (h ^ salt) & (1 << 64) - 1
    x = (x ^ x >> 30) * 0xBF58476D1CE4E5B9 & (1 << 64) - 1
    x = (x ^ x >> 27) * 0x94D049BB133111EB & (1 << 64) - 1
    return x ^ x >> 31


def test_wide_fingerprints_are_majorities_of_shingle_bits():
    r = np.random.default_rng(3)
    for n in (1, 4, 29, 700):
        hashes = r.integers(0, 1 << 64, n, dtype=np.uint64)
        segments, width = 29, 20
        words = -(-segments * width // 64) + simhash.CHECK
        votes = [sum(mixed(int(h), int(simhash.MIX[b // 64])) >> b % 64 & 1 for h in hashes) for b in range(64 * words)]
        own, check = simhash.wide_print(hashes, segments, width)
        for s, cell in enumerate(own.tolist()):
            part = votes[s * width:(s + 1) * width]
            assert cell & (1 << 32) - 1 == sum(1 << k for k, v in enumerate(part) if 2 * v > n)
            marked = [k for k in range(width) if cell >> 32 + k & 1]
            assert len(marked) == (4 if n > 30 else 12)
            assert max(abs(2 * part[k] - n) for k in marked) <= min(abs(2 * part[k] - n) for k in range(width) if k not in marked)
        assert [c & (1 << 64) - 1 for c in check.tolist()] == [sum(1 << b for b in range(64) if 2 * votes[64 * w + b] > n) for w in range(words - simhash.CHECK, words)]


def test_balls_hold_a_segment_and_its_marked_neighbours():
    got = simhash.ball(pa.array([[0b101 | 0b011 << 32, 7], [], [9 | 1 << 62]], pa.list_(pa.int64()))).to_pylist()
    assert got == [[0b101, 0b100, 0b111, 1 << 32 | 7], [], [9, 9 | 1 << 30]]


def test_pairs_at_the_resemblance_meet_in_a_bucket():
    """Sets that share 0.8, of 4 to 450 shingles: hardly one of them without a common key, and none too far apart to be compared."""
    r = np.random.default_rng(5)
    segments, width = simhash.layout(200_000)
    assert 1 << width > 32 * 200_000
    missed = far = 0
    for a, b, shared in ((4, 5, 4), (9, 9, 8), (20, 25, 20), (45, 45, 40), (160, 200, 160), (450, 450, 400)) * 50:
        h = r.integers(0, 1 << 64, a + b, dtype=np.uint64)
        (x, cx), (y, cy) = (simhash.wide_print(s, segments, width) for s in (h[:a], h[a - shared:a - shared + b]))
        kx, ky = simhash.ball(pa.array([x.tolist(), y.tolist()], pa.list_(pa.int64()))).to_pylist()
        missed += not set(kx) & set(ky)
        far += sum(((int(u) ^ int(v)) & (1 << 64) - 1).bit_count() for u, v in zip(cx, cy)) > simhash.APART * 64 * simhash.CHECK
    assert missed <= 1 and not far


def test_a_text_has_as_many_keys_in_any_table_up_to_16_million():
    assert simhash.layout(1000) == simhash.layout(44_000) == simhash.layout(220_000) == simhash.layout(16_000_000) == (45, 23)
    assert simhash.layout(200_000_000)[1] > 23


def test_a_large_group_of_near_copies_takes_few_comparisons(spark, monkeypatch):
    """Copies of one text, each with one word changed: pairs grow with the rows, not with their square or their keys."""
    r = random.Random(12)
    base = ["".join(r.choice("abcdefghij") for _ in range(7)) for _ in range(120)]
    texts = {}
    for i in range(300):
        own = list(base)
        own[r.randrange(120)] = f"w{i}"
        texts[i] = " ".join(own)
    compared, alike = [], simhash._alike
    monkeypatch.setattr(simhash, "_alike", lambda pairs, *rest: compared.append(pairs.count()) or alike(pairs, *rest))
    kept = {k.doc_id for k in simhash.deduplicated(spark.createDataFrame(sorted(texts.items()), "doc_id long, text string")).collect()}
    assert kept == firsts(texts, brute_links(texts))
    assert compared[0] <= 20 * len(texts)


def test_cells_bring_the_same_rows_together_as_keys():
    r = np.random.default_rng(8)
    segments, width, prefix = 45, 23, 3
    prints = []
    for _ in range(60):
        h = r.integers(0, 1 << 64, r.integers(1, 60), dtype=np.uint64)
        prints += [simhash.wide_print(np.unique(x), segments, width)[0].tolist() for x in (h, np.append(h, r.integers(0, 1 << 64, 2, dtype=np.uint64)))]
    prints = pa.array(prints, pa.list_(pa.int64()))
    row, cell, segment = simhash.cells(prints, width, prefix)
    entered = {(a, c, s) for a, c, s in zip(row.tolist(), cell.tolist(), segment.tolist())}
    want = {(a, (k >> 32) << prefix | (k & 0xFFFFFFFF) >> width - prefix, prints[a][k >> 32].as_py())
            for a, keys in enumerate(simhash.ball(prints).to_pylist()) for k in keys}
    assert entered == want and len(row) == len(want)


def test_groups_of_pairs():
    r = np.random.default_rng(2)
    for size in (1, 10, 500):
        a, b = r.integers(0, size, (2, size // 2))
        label = simhash.joined(a, b, size)
        texts = dict.fromkeys(range(size))
        assert {i for i in range(size) if label[i] == i} == firsts(texts, set(zip(a.tolist(), b.tolist()))) and (label[a] == label[b]).all()
