import itertools
import random
import re

import xxhash

from tamiz.llm.components import components
from tamiz.llm.simhash import near_duplicates, near_fingerprints, one_of_each, simhash


def brute_print(text):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    if not w:
        return 0
    shingles = [" ".join(w[i : i + 3]) for i in range(max(1, len(w) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def brute_components(nodes, links):
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in links:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    return {n: find(n) for n in nodes}


def test_fingerprints(odd_documents):
    for r in odd_documents.collect():
        assert simhash((r["text"] or "").encode()) == brute_print(r["text"])


def test_links_are_all_close_pairs(spark):
    rng = random.Random(5)
    prints = {0, signed(1 << 63), -1}
    for _ in range(60):
        base = rng.getrandbits(64)
        for bits in (0, 1, 2, 3, 4, 5):
            flip = sum(1 << b for b in rng.sample(range(64), bits))
            prints.add(signed(base ^ flip))
    rows = spark.createDataFrame([(p,) for p in prints] + [(None,)], "fingerprint long")
    for most in (3, 2, 1, 0):
        got = {tuple(r) for r in near_fingerprints(rows, max_bits=most).collect()}
        want = {(a, b) for a, b in itertools.combinations(sorted(prints), 2)
                if ((a ^ b) & (2**64 - 1)).bit_count() <= most}
        assert got == want


def test_components_of_chains_and_stars(spark):
    rng = random.Random(2)
    chain = list(range(100, 160))
    rng.shuffle(chain)
    links = list(zip(chain, chain[1:])) + [(1, k) for k in range(2, 30)] + [(5, 5), (None, 3)]
    links += [(rng.randrange(1000, 1100), rng.randrange(1000, 1100)) for _ in range(70)]
    frame = spark.createDataFrame(links, "a long, b long")
    real = [(a, b) for a, b in links if a is not None and a != b]
    want = brute_components({x for p in real for x in p}, real)
    assert {r["node"]: r["root"] for r in components(frame).collect()} == want
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def near_rows(spark):
    rng = random.Random(1)
    words = [f"w{i}" for i in range(500)]
    rows = []
    for k in range(12):
        base = [rng.choice(words) for _ in range(400)]
        for c in range(4):
            own = list(base)
            for _ in range(c):
                own[rng.randrange(400)] = "changed"
            rows.append((len(rows) * 7 % 1000, " ".join(own), "src"))
    return rows


def test_near_duplicates_against_brute_force(spark, odd_documents):
    rows = near_rows(spark) + [(r["doc_id"], r["text"], "odd") for r in odd_documents.collect()]
    frame = spark.createDataFrame(rows, "doc_id long, text string, fingerprint string")
    prints = {t: signed(brute_print(t)) for _, t, _ in rows}
    nodes = set(prints.values())
    links = [(a, b) for a, b in itertools.combinations(nodes, 2)
             if ((a ^ b) & (2**64 - 1)).bit_count() <= 3]
    root = brute_components(nodes, links)
    least = {}
    for i, t, _ in rows:
        if i is not None:
            r = root[prints[t]]
            least[r] = min(least.get(r, i), i)
    want = sorted(str((i, prints[t], least.get(root[prints[t]]))) for i, t, _ in rows)
    got = near_duplicates(frame).collect()
    assert sorted(str((r["doc_id"], r["fingerprint"], r["component_id"])) for r in got) == want
    kept = one_of_each(frame)
    assert kept.columns == frame.columns
    kept = kept.collect()
    groups = [root[prints[r["text"]]] for r in kept]
    assert sorted(groups) == sorted(set(root.values()))
    assert all(r["doc_id"] == least.get(g) for r, g in zip(kept, groups))


def test_empty_table(no_documents):
    assert near_duplicates(no_documents).count() == 0
    assert one_of_each(no_documents).count() == 0
