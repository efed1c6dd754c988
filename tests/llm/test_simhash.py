"""Near-duplicate groups against all pairs of fingerprints and union-find."""

import re

import xxhash

from posterion.llm import queries, simhash


def brute_fingerprint(text):
    words = re.findall("[^\x20\x09-\x0d]+", re.sub("[A-Z]+", lambda m: m.group().lower(), text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(rows):
    parent = {}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    prints = {d: brute_fingerprint(t) for d, t in rows}
    for d in prints:
        parent[d] = d
    ids = sorted(prints)
    for i, a in enumerate(ids):
        for b in ids[i + 1:]:
            if (prints[a] ^ prints[b]).bit_count() <= 3:
                x, y = sorted((find(a), find(b)))
                parent[y] = x
    return {d: (f"{prints[d]:016x}", find(d)) for d in ids}


def test_query_matches_brute_force(spark, data):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "text").collect()]
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in queries.QUERIES["op6_simhash_near_duplicates"](spark, data).collect()}
    assert got == brute_components(rows)


def test_chain_of_links_and_odd_rows(spark):
    chain = [(i, (1 << min(3 * i, 60)) - 1) for i in range(12)]          # each three bits from the next
    edges = simhash.links(spark.createDataFrame(chain, "id long, fp long"))
    root = {r.node: r.root for r in simhash.components(edges).collect()}
    assert len(root) == 11 and set(root.values()) == {0}
    rows = [(7, None, "x"), (3, "", "x"), (9, " \n", "x"), (5, "a b", "y"), (5, "a b", "y"), (None, "A B", "z"), (8, "w " * 3000, "z")]
    df = spark.createDataFrame(rows, "doc_id long, text string, fp string")
    got = simhash.near_duplicates(df).collect()
    assert len(got) == 7
    assert {r.component_id for r in got if r.doc_id in (3, 7, 9)} == {3}
    assert {r.component_id for r in got if r.doc_id in (5, None)} == {5}
    kept = simhash.deduplicated(df).collect()
    assert sorted((r.doc_id, r.fp) for r in kept) == [(3, "x"), (5, "y"), (8, "z")]
    assert simhash.deduplicated(df.limit(0)).columns == ["doc_id", "text", "fp"]
    assert simhash.near_duplicates(df.limit(0)).count() == 0
