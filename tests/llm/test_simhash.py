import collections

import numpy as np
import pytest
import xxhash
from cohortlens.llm import simhash
from cohortlens.session import Workspace
from llm_samples import document, prose


def brute_fingerprint(text):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in text.translate(dict.fromkeys(map(ord, "\t\n\x0b\x0c\r"), " ")).split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(marks):
    """Smallest id of each (id, fingerprint)'s component, by comparing all fingerprints."""
    fps = sorted({f for _, f in marks})
    root = list(range(len(fps)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(fps)):
        for j in range(i):
            if bin(fps[i] ^ fps[j]).count("1") <= 3:
                root[find(i)] = find(j)
    ids = collections.defaultdict(list)
    for i, f in marks:
        ids[find(fps.index(f))].append(i)
    smallest = {r: min((i for i in found if i is not None), default=None) for r, found in ids.items()}
    return {(i, f): smallest[find(fps.index(f))] for i, f in marks}


def test_documents_agree_with_brute_force(odd_docs):
    marks = [(r.doc_id, brute_fingerprint(r.text)) for r in odd_docs.collect()]
    expected = brute_components(set(marks))
    found = [(r.doc_id, int(r.fingerprint, 16), r.component_id) for r in simhash.near_duplicates(odd_docs).collect()]
    assert collections.Counter(found) == collections.Counter((i, f, expected[i, f]) for i, f in marks)


def near_codes(seed, n):
    """Random codes and chains of codes that differ in few bits, some packed densely."""
    rng = np.random.default_rng(seed)
    codes = rng.integers(0, 1 << 63, n, dtype=np.uint64)
    chains = [codes]
    for _ in range(3):
        flipped = chains[-1].copy()
        for _ in range(3):
            flipped ^= np.uint64(1) << rng.integers(0, 64, n).astype(np.uint64)
        chains.append(flipped)
    dense = codes[0] ^ rng.integers(0, 1 << 12, n, dtype=np.uint64)
    return sorted({int(c) for part in (*chains, dense) for c in part})


@pytest.mark.parametrize("limit", [2, 16, 4096])
def test_links_are_complete_whatever_the_shard_limit(spark, workspace, limit):
    codes = near_codes(limit, 60)
    nodes = spark.createDataFrame([(int(np.uint64(c).view(np.int64)),) * 2 for c in codes], "node long, fp long")
    edges = simhash.links(nodes, workspace, limit=limit)
    assert all(bin((a ^ b) & (2**64 - 1)).count("1") <= 64 and a > b for a, b in edges.collect())
    roots = {r.node: r.root for r in simhash.components(edges, workspace).collect()}
    expected = brute_components({(c, c) for c in codes})
    groups = collections.defaultdict(set)
    for c in codes:
        node = int(np.uint64(c).view(np.int64))
        groups[roots.get(node, node)].add(c)
    assert {frozenset(g) for g in groups.values()} == {
        frozenset(c for c in codes if expected[c, c] == r) for r in set(expected.values())
    }


def test_bk_search_finds_every_near_pair():
    codes = np.array(near_codes(5, 40), dtype=np.uint64)
    group = np.arange(len(codes)) % 3
    found = {(int(a), int(b)) for x, y in simhash.BKForest(group, codes).search(3) for a, b in zip(x, y, strict=True)}
    expected = {
        (a, b)
        for a in range(len(codes))
        for b in range(len(codes))
        if a != b and group[a] == group[b] and int(codes[a] ^ codes[b]).bit_count() <= 3
    }
    assert found == expected


def test_long_chain_is_one_component(spark, workspace):
    edges = spark.createDataFrame([(i + 1, i) for i in range(200)], "a long, b long")
    assert {r.root for r in simhash.components(edges, workspace).collect()} == {0}


def test_one_document_of_each_group_stays(odd_docs):
    kept = simhash.keep_first(odd_docs)
    assert kept.columns == odd_docs.columns
    groups = {r["class"] for r in simhash.near_duplicates(odd_docs).collect()}
    assert kept.count() == len(groups)
    assert kept.exceptAll(odd_docs).isEmpty()


def test_copies_collapse_and_others_stay(spark):
    rows = [document(i, prose(1, 200)) for i in range(300)] + [document(1000 + i, prose(100 + i, 200)) for i in range(5)]
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string").repartition(8)
    assert sorted(r.doc_id for r in simhash.keep_first(docs).collect()) == [0, 1000, 1001, 1002, 1003, 1004]


def test_empty_table_and_radius(no_docs, spark):
    assert simhash.near_duplicates(no_docs).isEmpty() and simhash.keep_first(no_docs).isEmpty()
    with pytest.raises(ValueError):
        simhash.links(spark.range(0).selectExpr("id node", "id fp"), Workspace(spark), radius=4)
