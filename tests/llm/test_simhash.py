import random

import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from proseframe.llm.components import connected
from proseframe.llm.simhash import near_pairs, one_per_group, simhash, simhash_groups


def brute(text):
    words = "".join(c.lower() if c.isascii() else c for c in text or "").replace("\x1c", "\x1c")
    words = [w for w in words.translate({c: 32 for c in range(9, 14)}).split(" ") if w]
    grams = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)) if hashes else 0


@settings(max_examples=100, deadline=None)
@given(st.text(alphabet="aAbÉ \t\n\x1c\xa0.", max_size=40))
def test_fingerprint(text):
    assert simhash(text) % 2**64 == brute(text)


def find(pairs, nodes):
    root = {n: n for n in nodes}

    def top(n):
        while root[n] != n:
            root[n] = root[root[n]]
            n = root[n]
        return n

    for a, b in pairs:
        root[max(top(a), top(b))] = min(top(a), top(b))
    return {n: top(n) for n in nodes}


def test_components(spark):
    rng = random.Random(1)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(170)] + [(i, i + 1) for i in range(1000, 1040)] + [(5000, i) for i in range(2000, 2100)] + [(None, 3), (4, 4)]
    want = find([(a, b) for a, b in edges if a is not None], {n for e in edges for n in e if n is not None and None not in e and e[0] != e[1]})
    got = {r.node: r.root for r in connected(spark.createDataFrame(edges, "u bigint, v bigint")).collect()}
    assert got == want
    assert connected(spark.createDataFrame([], "u bigint, v bigint")).count() == 0


def test_pairs(spark):
    rng = random.Random(2)
    prints = {rng.getrandbits(64) for _ in range(300)} | {0, 2**64 - 1}
    for base in list(prints)[:60]:
        for flips in range(1, 6):
            for _ in range(3):
                prints.add(base ^ sum(1 << b for b in rng.sample(range(64), flips)))
    signed = [p - 2**64 if p >= 2**63 else p for p in prints]
    for distance, segments in ((3, 2), (3, 4), (1, 2)):
        got = {frozenset((r.u, r.v)) for r in near_pairs(spark.createDataFrame([(p,) for p in signed], "fp bigint"), distance, segments).collect()}
        want = {frozenset((a, b)) for i, a in enumerate(signed) for b in signed[:i] if ((a ^ b) % 2**64).bit_count() <= distance}
        assert got == want


def test_groups(spark, odd, empty):
    rows = odd.collect()
    prints = [brute(r.text) for r in rows]
    linked = [(i, j) for i in range(len(rows)) for j in range(i) if (prints[i] ^ prints[j]).bit_count() <= 3]
    top = find(linked, range(len(rows)))
    want = []
    for i, r in enumerate(rows):
        ids = [rows[j].doc_id for j in range(len(rows)) if top[j] == top[i] and rows[j].doc_id is not None]
        want.append((str(r.doc_id), prints[i], min(ids) if ids else None))
    got = [(str(r.id), r.fp % 2**64, r.component_id) for r in simhash_groups(odd).collect()]
    assert sorted(map(str, got)) == sorted(map(str, want))
    left = one_per_group(odd)
    assert left.columns == odd.columns
    kept = [(r.doc_id, r.text) for r in left.collect()]
    assert len(kept) == len(set(top.values())) and {top[[r.text for r in rows].index(t)] for _, t in kept} == set(top.values())
    assert {i for i, _ in kept if i is not None} == {c for *_, c in want if c is not None}
    assert simhash_groups(empty).count() == 0 and one_per_group(empty).count() == 0
