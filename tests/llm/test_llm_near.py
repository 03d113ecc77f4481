"""Near-duplicate texts and vectors, components and shards."""

import re

import numpy as np
import pytest
from llm_cases import no_docs, odd_docs, shipped  # noqa: F401

from docklens.llm import embeddings_lsh, sharding, superminhash
from docklens.llm.components import connected
from docklens.llm.superminhash import Near


def groups(ids, edges):
    parent = {i: i for i in ids}

    def find(v):
        while parent[v] != v:
            v = parent[v]
        return v

    for a, b in edges:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def shingles(text, size):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    found = re.findall(r"[^\x20\x09-\x0D]+", lower)
    if len(found) < size:
        return {tuple(found)} if found else set()
    return {tuple(found[i : i + size]) for i in range(len(found) - size + 1)}


def brute(texts, size, percent=80):
    sets = {i: shingles(t, size) for i, t in texts.items()}
    ids = sorted(sets)
    edges = []
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                edges.append((a, b))
    found = groups(ids, edges)
    return {i: (len(sets[i]), found[i]) for i in ids}


def near_texts(seed=0):
    """Copies, chains, a star whose copies are far from each other, a shared passage."""
    random = np.random.default_rng(seed)

    def words(n):
        return [f"w{k}" for k in random.integers(0, 5000, n)]

    texts, star = [], words(400)
    texts.append(star)
    for _ in range(60):
        one = list(star)
        for k in random.choice(400, 18, replace=False):
            one[k] = words(1)[0]
        texts.append(one)
    chain = words(200)
    for _ in range(20):
        chain = list(chain)
        for k in random.choice(200, 8, replace=False):
            chain[k] = words(1)[0]
        texts.append(chain)
    passage = words(60)
    texts += [words(15) + passage + words(15) for _ in range(60)]
    texts += [words(30) for _ in range(50)]
    texts += [texts[3]] * 5
    texts += [words(1), texts[-1], [], ["W1"], ["w1"]]
    order = random.permutation(len(texts))
    return {int(i): " ".join(texts[k]) for i, k in enumerate(order)}


@pytest.mark.parametrize("size,block", [(2, 1024), (2, 16), (5, 16)])
def test_near_duplicates_by_brute_force(spark, size, block):
    texts = near_texts()
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    rows = superminhash.near_duplicates(df, near=Near(shingle=size, block=block)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in rows} == brute(texts, size)
    assert all(r.kept == (r.doc_id == r.component_id) for r in rows)


def brute_rows(rows, size):
    """(id, shingles, component id) of (id, text) rows that may repeat ids or have none."""
    found = brute({n: text for n, (_, text) in enumerate(rows)}, size)
    least = {}
    for n, (id_, _) in enumerate(rows):
        least.setdefault(found[n][1], set()).add((id_ is None, id_ or 0))
    out = []
    for n, (id_, _) in enumerate(rows):
        none, component = min(least[found[n][1]])
        out.append((id_, found[n][0], None if none else component))
    return sorted(out, key=str), len({part for _, part in found.values()})


def test_near_duplicates_of_odd_texts(spark, odd_docs, no_docs):
    rows = superminhash.near_duplicates(odd_docs).collect()
    texts = [(r.doc_id, r.text) for r in odd_docs.collect()]
    want, kept = brute_rows(texts, 5)
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in rows), key=str) == want
    assert sum(r.kept for r in rows) == kept
    assert superminhash.near_duplicates(no_docs).count() == 0
    kept = superminhash.deduplicate(odd_docs)
    assert kept.columns == odd_docs.columns
    assert sorted(r.doc_id or 0 for r in kept.collect()) == [0, 1, 2, 3, 4, 5, 6, 7, 8]


def test_rows_that_repeat_an_id_or_have_none_are_rows_of_their_own(spark):
    a, b, c = ("".join(f"{w}{n} " for n in range(30)) for w in "abc")
    rows = [
        (1, a), (1, b), (1, a), (2, c), (None, a), (None, a), (None, c + "more"), (3, b + "x"),
        (None, "alone " * 9), (None, "alone " * 9), (4, ""), (4, ""), (4, None), (None, " "),
    ]
    docs = spark.createDataFrame([(*r, n) for n, r in enumerate(rows)], "`doc.id` long, text string, n int")
    found = superminhash.near_duplicates(docs, "doc.id").collect()
    want, kept = brute_rows(rows, 5)
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in found), key=str) == want
    assert sum(r.kept for r in found) == kept == 8
    left = superminhash.deduplicate(docs, "doc.id")
    assert left.columns == docs.columns
    left = [tuple(r)[:2] for r in left.collect()]
    assert sorted(left, key=str) == sorted(
        [(1, a), (1, b), (2, c), (None, "alone " * 9), *rows[10:]], key=str
    )


def test_no_document_is_lost_to_a_hot_id(spark):
    texts = near_texts(4)
    rows = [(n % 3 or None, t) for n, t in texts.items()]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    found = superminhash.near_duplicates(docs, near=Near(block=16)).collect()
    want, kept = brute_rows(rows, 5)
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in found), key=str) == want
    assert sum(r.kept for r in found) == superminhash.deduplicate(docs, near=Near(block=16)).count() == kept


def test_signatures_estimate_without_bias():
    random = np.random.default_rng(0)
    for n in (5, 50, 2000):
        found = []
        for _ in range(60):
            x = random.integers(0, 1 << 63, 2 * n, dtype=np.uint64)
            k = int(n * 8 / 9)  # 0.8 of the union
            a, b = superminhash.signatures([x[:n], x[n - k : 2 * n - k]], 128)
            found.append(np.mean(a == b) - k / (2 * n - k))
        assert abs(np.mean(found)) < 0.02
        assert np.std(found) < np.sqrt(0.8 * 0.2 / 128)  # that of independent hashes


def test_signature_does_not_depend_on_the_batch():
    random = np.random.default_rng(0)
    sets = [random.integers(0, 1 << 63, n, dtype=np.uint64) for n in (0, 1, 3, 900, 20, 0)]
    whole = superminhash.signatures(sets, 64)
    assert all(np.array_equal(superminhash.signatures([s], 64)[0], w) for s, w in zip(sets, whole))
    assert (whole[1] >> np.uint64(32)).tolist() != [0] * 64  # one element takes all steps


def test_shared_sizes():
    random = np.random.default_rng(2)
    sets = [np.unique(random.integers(0, 300, n).astype(np.uint64)) for n in (0, 5, 80, *[150] * 60)]
    want = [[len(np.intersect1d(a, b)) for b in sets] for a in sets]
    for dense in (2, 8, 32, 100):
        got = superminhash._shared(sets, dense)
        assert (np.triu(got, 1) == np.triu(want, 1)).all()


def test_components(spark):
    random = np.random.default_rng(3)
    edges = [(int(a), int(b)) for a, b in random.integers(0, 3000, (1500, 2))]
    edges += [(5000 + k, 5001 + k) for k in range(300)] + [(9000, 9000 + k) for k in range(500)]
    df = spark.createDataFrame([*edges, (1, None), (None, 2), (7, 7)], "a long, b long")
    vertices = {v for a, b in edges if a != b for v in (a, b)}
    got = {r.id: r.component_id for r in connected(df.repartition(7)).collect()}
    assert got == groups(vertices, [(a, b) for a, b in edges if a != b])
    assert connected(df.limit(0)).count() == 0


# ---- vectors


def vector_rows():
    random = np.random.default_rng(4)
    rows = []
    for label in (0, 1, None):
        for _ in range(6):
            centre = random.normal(size=16)
            for spread in (0.02, 0.04, 0.05, 0.06):
                for _ in range(6):
                    rows.append([(centre + random.normal(0, spread, 16)).tolist(), label])
    rows += [[rows[0][0], 0]] * 4 + [[[2 * x for x in rows[0][0]], 0], [rows[0][0], 1]]
    nan, inf = float("nan"), float("inf")
    odd = ([], None, [0.0] * 16, [None, 1.0], [nan, 1.0], [inf, 1.0], [1e300, 1e300], [1e300, 1.1e300])
    rows += [[v, 0] for v in odd]
    return [(n, v, label, 9) for n, (v, label) in enumerate(rows)]


@pytest.mark.parametrize("chunk", [1024, 8])
def test_vectors_by_brute_force(spark, chunk):
    rows = vector_rows()
    links = {r[0]: 0 for r in rows}
    edges = []
    able = {}
    for n, v, label, _ in rows:
        if v and label is not None and None not in v and np.isfinite(v).all() and any(v):
            x = np.array(v) / np.abs(v).max()
            able[n] = (label, x / np.linalg.norm(x))
    for a in able:
        for b in able:
            if a < b and able[a][0] == able[b][0] and len(able[a][1]) == len(able[b][1]):
                if able[a][1] @ able[b][1] >= 0.98:
                    edges.append((a, b))
                    links[a] += 1
                    links[b] += 1
    assert len(edges) > 300
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int, kept int")
    search = embeddings_lsh.Search(chunk=chunk)
    got = embeddings_lsh.near_vectors(df.repartition(3), search=search).collect()
    found = groups(links, edges)
    assert sum(r.n_links for r in got) >= 0.99 * sum(links.values())
    assert all(r.n_links <= links[r.vec_id] for r in got)
    wrong = [r for r in got if (r.n_links, r.component_id) != (links[r.vec_id], found[r.vec_id])]
    assert len(got) == len(rows) and len(wrong) <= 2
    assert all(r.kept == (r.component_id == r.vec_id) for r in got)


def test_recall_by_brute_force(spark):
    random = np.random.default_rng(5)
    rows, pairs = [], 0
    for n in range(400):  # pairs at the cosine itself, the hardest to find
        x = random.normal(size=64)
        x /= np.linalg.norm(x)
        y = random.normal(size=64)
        y -= (y @ x) * x
        y /= np.linalg.norm(y)
        rows += [(2 * n, x.tolist(), 0), (2 * n + 1, (0.9801 * x + np.sqrt(1 - 0.9801**2) * y).tolist(), 0)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    pairs = embeddings_lsh.near_vectors(df).where("n_links > 0").count() / 2
    assert pairs >= 0.99 * 400


def test_rows_that_share_an_id_or_have_none(spark):
    a, b, c = [1.0, 0.0, 0.0], [0.0, 1.0, 0.0], [0.0, 0.0, 1.0]
    near_a = [1.0, 0.01, 0.0]
    rows = [
        (1, a, 0), (1, a, 0), (1, b, 0),  # one id: a copy, and another vector
        (None, near_a, 0), (None, a, 0),  # linked with 1's
        (None, c, 0), (None, c, 0),  # linked with each other only
        (2, b, 0), (None, None, 0), (3, a, None),
    ]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = embeddings_lsh.near_vectors(df.repartition(4)).collect()
    assert sorted((r.vec_id or -1, r.n_links, r.component_id or -1) for r in got) == sorted(
        [(1, 3, 1), (1, 3, 1), (-1, 3, 1), (-1, 3, 1)]
        + [(1, 1, 1), (2, 1, 1)]
        + [(-1, 1, -1), (-1, 1, -1), (-1, 0, -1), (3, 0, 3)]
    )
    # one row of each of the components {a}, {b}, {c}; rows that link with nothing stay
    assert sum(r.kept for r in got) == 3 + 2
    assert all(r.kept for r in got if r.n_links == 0)


def test_no_vectors(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert embeddings_lsh.near_vectors(df).count() == 0


# ---- shards


def check_shards(rows, shards):
    counts = [sum(r.shard == k for r in rows) for k in range(shards)]
    assert sum(counts) == len(rows) and max(counts) - min(counts) <= 1
    for k in range(shards):
        assert sorted(r.slot for r in rows if r.shard == k) == list(range(counts[k]))
    assert {r.law for r in rows} <= {"rows"} and all(r.grown_shard is None for r in rows)


def test_groups_stay_together(spark):
    texts = [f"text {n}" for n in range(120)]
    texts += [f"pair {n // 2}" for n in range(80)] + [f"ten {n // 10}" for n in range(100)]
    texts += ["hot"] * 150
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = sharding.shard_documents(df.repartition(3), 8).collect()
    check_shards(rows, 8)
    of = {}
    for r in rows:
        of.setdefault(texts[r.doc_id], set()).add(r.shard)
        assert r.size == len(texts[r.doc_id]) + 1
    split = [t for t, s in of.items() if len(s) > 1]
    assert "hot" in split and len(of["hot"]) <= 6
    assert len(split) <= 4
    again = sharding.shard_documents(df.repartition(5), 8).collect()
    assert {(r.doc_id, r.shard, r.slot) for r in again} == {(r.doc_id, r.shard, r.slot) for r in rows}


def test_shards_of_odd_texts(spark, odd_docs, no_docs):
    import zlib

    rows = sharding.shard_documents(odd_docs, 8).collect()
    assert len(rows) == odd_docs.count()
    check_shards(rows, 8)
    texts = {r.doc_id: (r.text or "").encode() for r in odd_docs.collect()}
    assert all(
        (r.size, r.text_crc32) == (len(texts[r.doc_id]) + 1, zlib.crc32(texts[r.doc_id]))
        for r in rows
    )
    assert sharding.shard_documents(no_docs, 8).count() == 0


def test_sharding_and_chat_have_no_python(spark, odd_docs):
    plan = sharding.shard_documents(odd_docs, 8)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
