"""Spelling variants, host reputation and the Merkle manifest against plain Python."""

import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from llm_cases import by_id, no_docs, odd_docs, shipped  # noqa: F401
from pyspark.sql import functions as F

from docklens.llm import merkle, reputation, variants

# Spelling variants

RUN = re.compile("[A-Za-z\u00c0-\u00ff]+")
LOW = {i: i + 32 for i in range(65, 91)}


def plain_variants(rows, least_count=3):
    n = collections.Counter()
    for doc_id, text in rows:
        for run in RUN.findall(text or ""):
            word = run.translate(LOW)
            crc = zlib.crc32(f"{doc_id}:{word}".encode())
            if doc_id is not None and crc % 97 == 0:
                at = crc % len(word)
                word = word[:at] + word[at + 1 :]
            n[word] += 1
    n = {w: k for w, k in n.items() if len(w) >= 5 and k >= least_count}
    holes, near = collections.defaultdict(set), collections.defaultdict(set)
    for w in n:
        for i in range(len(w)):
            holes[i, w[:i], w[i + 1 :]].add(w)
            shorter = w[:i] + w[i + 1 :]
            if shorter in n:
                near[w].add(shorter)
                near[shorter].add(w)
    for alike in holes.values():
        for w in alike:
            near[w] |= alike - {w}
    form = {}
    for w in n:
        best = min(near[w], key=lambda v: (-n[v], v), default=None)
        if best and n[best] >= 2 * n[w]:
            form[w] = best

    def root(w):
        return root(form[w]) if w in form else w

    return {w: (form.get(w), root(w), k, len(near[w]), n.get(form.get(w))) for w, k in n.items()}


def found_variants(docs, **options):
    rows = variants.group_variants(docs, **options).collect()
    assert len({r.word for r in rows}) == len(rows)
    return {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in rows}


def edited(chance, word, letters):
    at = chance.randrange(len(word))
    kind = chance.randrange(3)
    new = chance.choice(letters)
    return word[:at] + (new if kind else "") + word[at + (kind != 2) :]


@pytest.mark.parametrize("letters", ["ab", "abcdé", "abcdefghijklmnopqrstuvwxyzàéß×"])
def test_variants_by_brute_force(spark, letters):
    chance = random.Random(len(letters))
    vocabulary = ["".join(chance.choices(letters, k=chance.randint(4, 12))) for _ in range(60)]
    for _ in range(300):
        vocabulary.append(edited(chance, chance.choice(vocabulary), letters))
    vocabulary += ["a" * 30, "a" * 31, "a" * 90, "a" * 89 + "b", "ab" * 40, "ab" * 40 + "a"]
    rows = [
        (i, " ".join(chance.choices(vocabulary, k=400)).title() + " '" + chance.choice(vocabulary))
        for i in range(40)
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = plain_variants(rows)
    assert len(want) > 100 and sum(v[3] for v in want.values()) > 100
    assert found_variants(docs) == want
    assert found_variants(docs, least_count=1) == plain_variants(rows, 1)


def test_variants_of_odd_rows(spark, odd_docs, no_docs):
    rows = [(r.doc_id, r.text) for r in odd_docs.select("doc_id", "text").collect()]
    assert found_variants(odd_docs) == plain_variants(rows)
    assert found_variants(odd_docs, least_count=1) == plain_variants(rows, 1)
    assert found_variants(no_docs) == {}


def test_a_long_chain_of_forms(spark):
    rows = [(0, " ".join(["x" * k + "yzabc"] * 2 ** (9 - k))) for k in range(9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = found_variants(docs, least_count=1)
    assert found == plain_variants(rows, 1) and {v[1] for v in found.values()} == {"yzabc"}


@pytest.mark.parametrize("seed", range(3))
def test_one_of_two_near_words_has_a_pivot_in_the_other(seed):
    chance = random.Random(seed)
    letters = "ab" if seed == 0 else "abcdefgh"
    rank = np.random.default_rng(seed).permutation(1 << 16).astype(np.int32)
    counts = rank.astype(np.int64) + 1
    for _ in range(400):
        word = "".join(chance.choices(letters, k=chance.randint(5, 14)))
        other = edited(chance, word, letters)
        if other == word or len(other) < 5:
            continue
        keys = [([], []), ([], [])]
        ends = [0, 0]
        for at, key, pivot, last in variants.index_keys(pa.array([word, other]), rank, counts):
            for w, k, p, end in zip(at, key, pivot, last):
                keys[w][0 if p else 1].append(int(k))
                ends[w] = int(end)
        links = [ends[w] <= ends[1 - w] and bool({*keys[w][0]} & {*keys[1 - w][1]}) for w in (0, 1)]
        assert any(links), (word, other)


def test_pivots_are_the_cheapest_disjoint_pair():
    grams = np.array([[10, 11, 12, 13, 14, 15], [7, 7, 7, 7, 7, 7]])
    rank = np.arange(100, dtype=np.int32)[::-1].copy()  # the largest bigrams are the rarest
    counts = np.arange(100)
    held, last, first, second = variants.pivots(grams, rank, counts)
    assert held[0].tolist() == [False, False, False, True, True, True] and last[0] == 99 - 13
    assert (first[0], second[0]) == (3, 5)
    assert held[1].tolist() == [True] * 5 + [False] and (first[1], second[1]) == (0, 2)


def test_checksums_of_runs():
    texts = ["abc", "é", "a" * 200 + "ü", "zß", ""]
    values = np.frombuffer("".join(texts).encode("latin-1"), np.uint8)
    edge = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    state = np.array([zlib.crc32(f"{n}:".encode()) for n in range(5)], np.uint32)
    found = variants._crcs(values, edge[:-1], edge[1:], state)
    assert found.tolist() == [zlib.crc32(f"{n}:{t}".encode()) for n, t in enumerate(texts)]


# Host reputation

RULES = [
    reputation.Rule("allow", "com/"),
    reputation.Rule("block", "example.com/en/"),
    reputation.Rule("allow", "www.example.com/en/"),
    reputation.Rule("block", "net/es/"),
]


def plain_parse(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    return host.translate(LOW), re.match(r"[^?#]*", rest[len(host) :])[0]


def plain_rule(host, path):
    best = None
    for rule in RULES:
        own, start = rule.text.split("/", 1)
        if (host == own or host.endswith("." + own)) and path.startswith("/" + start):
            if best is None or len(rule.text) > len(best.text):
                best = rule
    return best


def plain_parents(host):
    name = re.sub(r"^[^@]*@|:[0-9]*$|\.(?::[0-9]*)?$", "", host)
    if re.match(r"^[0-9.]*$", name) or "[" in name:
        return name, ""
    labels = name.split(".")
    width = 2 if len(labels) > 2 and len(labels[-1]) == 2 and labels[-2] in reputation.GENERAL else 1
    suffix = ".".join(labels[-width:])
    return (".".join(labels[-width - 1 :]) if len(labels) > width else name), suffix


def plain_reputation(pages, outcomes, prior=reputation.Prior()):
    hosts = {plain_parse(url)[0]: [0, 0] for _, url in pages}
    for page, url in pages:
        for of, bad in outcomes:
            if page == of and page is not None and bad is not None:
                hosts[plain_parse(url)[0]][0] += 1
                hosts[plain_parse(url)[0]][1] += bad

    def summed(children, key):
        out = collections.defaultdict(lambda: [0, 0])
        for c, (n, k) in children.items():
            out[key(c)][0] += n
            out[key(c)][1] += k
        return out

    def strength(children, above):
        top = bottom = 0.0
        for c, (n, k) in children.items():
            p = above(c)
            top += (k - n * p) ** 2 - n * p * (1 - p)
            bottom += n * (n - 1) * p * (1 - p)
        return 1 / min(max(top / bottom if bottom else prior.most, prior.least), prior.most) - 1

    domains = summed(hosts, plain_parents)
    suffixes = summed(domains, lambda d: d[1])
    n, k = (sum(v[i] for v in suffixes.values()) for i in (0, 1))
    whole = (k + 0.5) / (n + 1)
    m = strength(suffixes, lambda s: whole)
    of_suffix = {s: (m * whole + k) / (m + n) for s, (n, k) in suffixes.items()}
    m = strength(domains, lambda d: of_suffix[d[1]])
    of_domain = {d: (m * of_suffix[d[1]] + k) / (m + n) for d, (n, k) in domains.items()}
    m = strength(hosts, lambda h: of_domain[plain_parents(h)])
    out = {}
    for h, (n, k) in hosts.items():
        p = of_domain[plain_parents(h)]
        a, b = m * p + k, m * (1 - p) + n - k
        out[h] = (n, k, 1 / (1 + math.exp(-(math.log(a / b) - prior.z * math.sqrt(1 / a + 1 / b)))))
    return out


def web(seed=1):
    """Pages of good and bad hosts and domains, and labels of most of them."""
    chance = random.Random(seed)
    shares = {}
    for suffix, low, high in (("com", 0, 0.3), ("org", 0.1, 0.9), ("co.uk", 0, 0.1), ("net", 0.6, 1)):
        for d in range(5):
            base = chance.uniform(low, high)
            for h in range(4):
                share = min(max(base + chance.uniform(-0.2, 0.2), 0), 1)
                shares[f"h{h}.d{d}.{suffix}"] = share
    pages, outcomes = [], []
    for host, share in shares.items():
        for _ in range(chance.choice([0, 1, 3, 30])):
            page = len(pages)
            pages.append((page, f"http://{host.upper()}/{chance.choice(['en', 'es'])}/{page}?q#x"))
            outcomes.append((page, chance.choice([None, chance.random() < share])))
        pages.append((len(pages), f"https://{host}"))
    pages += [
        (9001, None), (9002, "no address"), (9003, "://"), (None, "http://10.2.3.4:80/x"),
        (9004, "ftp://u:p@h1.d1.org.:21/a?b://c"), (9005, "http://[::1]/es/"), (9005, "http://net/es/"),
        (9006, "x://y://z/a#b"), (9007, "http://example.com/en/1"), (9008, "http://WWW.example.com/en/1"),
        (9009, "http://a.example.com/de/"), (9010, "http://notexample.com/en/"), (9011, "http://com"),
        (9012, "http://localhost/"), (9012, "http://localhost/"), (9013, "http://x.co.uk"),
    ]
    return pages, outcomes + [(9012, True), (9012, False), (None, True), (77777, True)]


def test_reputation_by_brute_force(spark):
    pages, outcomes = web()
    table = spark.createDataFrame(
        [(p, u, "x", 1) for p, u in pages], "page_id long, url string, host string, verdict int"
    )
    labels = spark.createDataFrame(outcomes, "page_id long, bad boolean")
    want = plain_reputation(pages, outcomes)
    rows = reputation.reputations(table, labels).collect()
    assert {r.host: (r.n, r.k) for r in rows} == {h: v[:2] for h, v in want.items()}
    assert len(rows) == len(want)
    for r in rows:
        assert math.isclose(r.bound, want[r.host][2], rel_tol=1e-9)
    limit = reputation.Prior().limit
    blocked = {h for h, v in want.items() if v[2] > limit}
    assert 5 < len(blocked) < len(want) - 5
    judged = []
    for page, url in pages:
        host, path = plain_parse(url)
        rule = plain_rule(host, path)
        verdict = rule.verdict if rule else "block" if host in blocked else "allow"
        judged.append((page, host, path, rule and rule.text, verdict))
    found = reputation.judge(table, labels, RULES)
    assert found.columns == ["page_id", "host", "path", "rule", "verdict"]
    key = lambda r: tuple(map(str, r))
    assert sorted(map(tuple, found.collect()), key=key) == sorted(judged, key=key)


def test_reputation_without_labels_or_pages(spark):
    pages = spark.createDataFrame([(1, "http://a.org/x"), (2, None)], "page_id long, url string")
    none = spark.createDataFrame([], "page_id long, bad boolean")
    assert [r.verdict for r in reputation.judge(pages, none).collect()] == ["allow"] * 2
    assert reputation.judge(pages.limit(0), none, RULES).collect() == []
    with pytest.raises(ValueError):
        reputation.Rule("allow", "com")


def test_a_host_with_few_labels_is_judged_by_its_domain(spark):
    """A host of a bad domain is blocked unseen; one bad page does not block a good domain's."""
    pages, outcomes = [], []
    for d in range(20):
        for n in range(200):
            pages.append((len(pages), f"http://h{n % 10}.d{d}.org/{n}"))
            outcomes.append((len(pages) - 1, n >= 10 if d < 5 else n < 10))
    pages += [(9001, "http://new.d1.org/"), (9002, "http://new.d9.org/"), (9003, "http://one.d8.org/")]
    outcomes.append((9003, True))
    found = reputation.judge(
        spark.createDataFrame(pages, "page_id long, url string"),
        spark.createDataFrame(outcomes, "page_id long, bad boolean"),
    )
    got = {r.page_id: r.verdict for r in found.where("page_id > 9000").collect()}
    assert got == {9001: "block", 9002: "allow", 9003: "allow"}


# Merkle manifest


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def plain_leaf(*values):
    return sha(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def plain_levels(leaves):
    levels = [leaves]
    while len(levels[-1]) > 1:
        below = levels[-1]
        levels.append([sha(*below[i : i + 3]) for i in range(0, len(below), 3)])
    return levels


def plain_path(levels, place):
    out = []
    for nodes in levels[:-1]:
        first = place - place % 3
        out.append(("".join(nodes[first:place]), "".join(nodes[place + 1 : first + 3])))
        place //= 3
    return out


def plain_manifest(rows):
    """(id, leaf, subroot, root, path) of (id, group, value) rows."""
    groups = collections.defaultdict(list)
    for id_, group, value in rows:
        groups[group].append((id_ is not None, id_ or 0, plain_leaf(id_, group, value)))
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {g: plain_levels([r[2] for r in sorted(groups[g])]) for g in order}
    top = plain_levels([trees[g][-1][0] for g in order])
    out = []
    for n, g in enumerate(order):
        for place, (known, id_, leaf) in enumerate(sorted(groups[g])):
            path = plain_path(trees[g], place) + plain_path(top, n)
            out.append((id_ if known else None, leaf, trees[g][-1][0], top[-1][0], path))
    return out


def found_manifest(rows, **options):
    found = merkle.manifest(rows, ["doc_id", "source", "text"], **options).collect()
    return [
        (r.doc_id, r.leaf, r.subroot, r.root, [(s.left, s.right) for s in r.path]) for r in found
    ]


def by_text(rows):
    return sorted(rows, key=str)


@pytest.mark.parametrize("levels", [1, 2, 7])
def test_manifest_by_brute_force(spark, monkeypatch, levels):
    monkeypatch.setattr(merkle, "LEVELS", levels)
    monkeypatch.setattr(merkle, "SPAN", 3**levels)
    chance = random.Random(levels)
    sizes = {None: 5, "": 1, "a": 3, "A": 4, "é": 2, "z": 28, "hot": 100, "=": 9, "b": 10}
    rows = [
        (chance.choice([None, *range(60)]), source, chance.choice([None, "", "x", "é\n1:"]))
        for source, n in sizes.items()
        for _ in range(n)
    ]
    rows += rows[:30]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string").repartition(3)
    found = found_manifest(docs)
    assert by_text(found) == by_text(plain_manifest(rows))


def test_manifest_of_odd_rows(spark, odd_docs, no_docs):
    docs = odd_docs.withColumn("source", F.lit("s")).withColumn("leaf", F.lit(1)).withColumn("key", F.lit(2))
    rows = [(r.doc_id, r.source, r.text) for r in docs.select("doc_id", "source", "text").collect()]
    assert by_text(found_manifest(docs)) == by_text(plain_manifest(rows))
    assert found_manifest(no_docs.withColumn("source", F.lit("s"))) == []
    one = docs.where("doc_id = 1")
    [(_, leaf, subroot, root, path)] = found_manifest(one)
    assert leaf == subroot == root and path == []


def test_proofs_hold_for_what_was_written_only(spark):
    rows = [(i, f"s{i % 3}", f"text\n{i}" if i % 2 else f"text {i}") for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string")
    changed = F.replace("text", F.lit("\n"), F.lit(""))
    kept = {
        "own": merkle.leaf_digest(F.col("doc_id"), F.col("source"), F.col("text")),
        "changed": merkle.leaf_digest(F.col("doc_id"), F.col("source"), changed),
    }
    found = merkle.manifest(docs, ["doc_id", "source", "text"], keep=kept)
    path = F.col("path")
    rows = found.select(
        "doc_id", "root", "path", merkle.proof_digest(path).alias("proof"),
        merkle.fold(F.col("own"), path).alias("own"), merkle.fold(F.col("changed"), path).alias("other"),
    ).collect()
    for r in rows:
        assert r.own == r.root and (r.other == r.root) == (r.doc_id % 2 == 0)
        assert r.proof == sha(*(s.left + s.right for s in r.path))


def test_windows_of_a_manifest_share_one_shuffle_and_hold_no_group(spark):
    rows = spark.range(100).select(
        (F.col("id") % 2).alias("key"), F.col("id").alias("place"), F.lit(100).cast("long").alias("size"),
        F.lit("h").alias("hash"),
    )
    plan = merkle._levels(rows)._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"Exchange hashpartitioning\(key#\d+L?, span#", plan)) == 1
    assert plan.count("Exchange") == 1 and "SinglePartition" not in plan
