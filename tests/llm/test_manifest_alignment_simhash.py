"""Merkle manifest, token alignment and SimHash components against brute force."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from homematch.llm import alignment, merkle, simhash

tokenizer_files = pytest.importorskip("public_tokenizers")
PIECES, BYTES = tokenizer_files.path("piece_bpe_32k.model"), tokenizer_files.path("byte_bpe_50k.json")
FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]


def hashed(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(values):
    return hashed(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])


def tree(nodes, fanout):
    """Root of a list of nodes and each one's siblings, level by level, as (before, after)."""
    proofs = [[] for _ in nodes]
    level = [(node, [i]) for i, node in enumerate(nodes)]
    while len(level) > 1:
        above = []
        for start in range(0, len(level), fanout):
            run = level[start:start + fanout]
            for k, (_, members) in enumerate(run):
                for m in members:
                    proofs[m].append(([n for n, _ in run[:k]], [n for n, _ in run[k + 1:]]))
            above.append((hashed(*[n for n, _ in run]), [m for _, members in run for m in members]))
        level = above
    return level[0][0], proofs


def brute_manifest(rows, fanout, changed):
    """(doc_id, leaf, subroot, root, proof, folded root) of every row."""
    groups = {}
    for r in rows:
        values = [r[f] for f in FIELDS]
        now = leaf_of([v + 1 if f == "n_chars" and r.doc_id in changed and v is not None else v for f, v in zip(FIELDS, values, strict=True)])
        groups.setdefault(r.lang, []).append((r.doc_id is not None, r.doc_id or 0, leaf_of(values), now, r.doc_id))
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    subs = {}
    for g in names:
        groups[g].sort()
        subs[g] = tree([x[2] for x in groups[g]], fanout)
    root, top = tree([subs[g][0] for g in names], fanout)
    out = Counter()
    for g, rest in zip(names, top, strict=True):
        for (_, _, leaf, now, key), path in zip(groups[g], subs[g][1], strict=True):
            whole, folded = path + rest, now
            for before, after in whole:
                folded = hashed(*before, folded, *after)
            out[key, leaf, subs[g][0], root, hashed(*[n for b, a in whole for n in b + a]), folded, folded == root] += 1
    return out


def found_manifest(docs, fanout, changed):
    now = F.when(F.col("doc_id").isin(list(changed)), F.col("n_chars") + 1).otherwise(F.col("n_chars"))
    held = merkle.dataset_manifest(docs, FIELDS, {"n_chars": now}, fanout)
    shown = [F.lower(F.hex(c)).alias(c) for c in ("leaf", "subroot", "root", "folded_root")]
    rows = held.select("doc_id", *shown, merkle.siblings_digest(F.col("path")).alias("proof"), "verified").collect()
    return Counter((r.doc_id, r.leaf, r.subroot, r.root, r.proof, r.folded_root, r.verified) for r in rows)


@pytest.mark.parametrize("fanout", [2, 3])
def test_manifest_of_odd_rows(odd, empty, fanout):
    assert found_manifest(odd, fanout, {2, 7}) == brute_manifest(odd.collect(), fanout, {2, 7})
    assert merkle.dataset_manifest(empty, FIELDS).count() == 0
    one = odd.where("doc_id = 8")
    assert found_manifest(one, fanout, set()) == brute_manifest(one.collect(), fanout, set())


def test_manifest_over_several_stages(spark, monkeypatch):
    monkeypatch.setattr(merkle, "LEVELS", 2)
    r = random.Random(3)
    rows = [(i if i % 50 else None, r.choice(["s", None]), r.choice(["en"] * 9 + ["é", "z", None]), i if i % 3 else None, "same" if i > 200 else f"text {i}") for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id bigint, source string, lang string, n_chars bigint, text string").repartition(5)
    assert found_manifest(docs, 2, {7, 8, 9, 250}) == brute_manifest(docs.collect(), 2, {7, 8, 9, 250})


def test_values_do_not_run_together(spark):
    rows = spark.createDataFrame([("ab", "c"), ("a", "bc"), (None, "abc"), ("-", "abc"), ("", "abc")], "x string, y string")
    assert rows.select(merkle.leaf(F.col("x"), F.col("y")).alias("l")).distinct().count() == 5


@pytest.fixture(scope="module")
def known():
    return alignment.load_vocabularies(BYTES, PIECES)


@pytest.fixture(scope="module")
def libraries():
    import sentencepiece
    from tokenizers import Tokenizer

    byte_level = Tokenizer.from_file(BYTES)
    byte_level.encode_special_tokens = True
    return byte_level, sentencepiece.SentencePieceProcessor(model_file=PIECES)


def brute_alignment(known, libraries, text):
    """(n_a, n_b, groups, links) by a walk along both token rows."""
    a = libraries[0].encode(f" {text}", add_special_tokens=False).ids if text else []
    b = libraries[1].encode(text) if text else []
    raw_a, raw_b = [known["a"][i] for i in a], [known["b"][i] for i in b]
    if not text or not b"".join(raw_a) == b"".join(raw_b) == f" {text}".encode():
        return 0, 0, "", []
    groups, links, i, k, at_a, at_b, own_a, own_b = [], [], 0, 0, 0, 0, [], []
    while i < len(a) or k < len(b):
        if at_a <= at_b and i < len(a):
            own_a.append(a[i])
            at_a, i = at_a + len(raw_a[i]), i + 1
        else:
            own_b.append(b[k])
            at_b, k = at_b + len(raw_b[k]), k + 1
        if at_a == at_b:
            groups.append(f"{','.join(map(str, own_a))}|{','.join(map(str, own_b))}")
            links.append((own_a[-1], own_b[-1]))
            own_a, own_b = [], []
    return len(a), len(b), ";".join(groups), links


def pairs_of(known, links):
    numbers = known["pairs"][np.frombuffer(links, "<i4")]
    return list(zip((numbers // len(known["b"])).tolist(), (numbers % len(known["b"])).tolist(), strict=True))


PARTS = ["a", "e", " ", "  ", "\n", "'s", "th", "é", "\x1c", "\x85", ".", "1", "\t", "\r\n", "日", "\U0001F600", "$ ", "\x00", "<|endoftext|>", "ß", "The", "<0x41>", "​", " ", "<s>", "<unk>", "ing house", "　"]


def test_alignment_against_a_walk(known, libraries):
    r = random.Random(6)
    texts = ["".join(r.choice(PARTS) for _ in range(r.randint(0, 60))) for _ in range(1500)] + ["▁ a", None, " ", "the houses " * 3000, "x" * 5000, "日" * 3000]
    use = alignment.Aligner(known)
    for n_a, n_b, n_groups, groups, links, text in [(*x, t) for x, t in zip(use.align(texts), texts, strict=True)]:
        expected = brute_alignment(known, libraries, text)
        assert (n_a, n_b, groups, pairs_of(known, links)) == expected and n_groups == len(expected[3])


def test_alignment_counts_over_all_documents(odd, empty, known, libraries):
    rows = alignment.with_counts(alignment.align_documents(odd, known), known).collect()
    expected = [(r.doc_id, *brute_alignment(known, libraries, r.text)) for r in odd.collect()]
    counts = Counter(p for *_, links in expected for p in links)
    most = {}
    for (_, b), n in counts.items():
        most[b] = max(most.get(b, 0), n)
    wanted = Counter((key, n_a, n_b, len(links), groups, len(links), sum(counts[p] == most[p[1]] for p in links), sum(counts[p] for p in links)) for key, n_a, n_b, groups, links in expected)
    assert Counter((r.doc_id, r.n_a, r.n_b, r.n_groups, r.groups, r.n_links, r.n_best, r.count_sum) for r in rows) == wanted
    assert alignment.with_counts(alignment.align_documents(empty, known), known).count() == 0


def test_cuts_of_random_ends():
    r = random.Random(9)
    for _ in range(300):
        total = r.randint(1, 60)
        rows = [sorted({*r.sample(range(1, total + 1), r.randint(0, total)), total}) for _ in range(2)]
        a, b = shared = [np.array(x) for x in rows]
        cut_a, cut_b = alignment.shared_cuts(*shared, np.array([len(a) - 1]), np.array([len(b) - 1]))
        assert a[cut_a].tolist() == b[cut_b].tolist() == sorted(set(rows[0]) & set(rows[1]))


def brute_fingerprint(text, width):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i:i + width]) for i in range(max(1, len(words) - width + 1))] if words else []
    values = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(v >> b & 1 for v in values) > len(values))


def brute_parts(marks):
    """Smallest id reachable over links of at most three bits; ``marks`` has (id, fingerprint)."""
    root = {i: i for i, _ in marks}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for k, (i, a) in enumerate(marks):
        for j, b in marks[k:]:
            if (a ^ b).bit_count() <= 3:
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    return {i: find(i) for i in root}


def test_simhash_of_odd_rows(odd, empty):
    found = simhash.simhash_duplicates(odd).collect()
    rows = [(r.doc_id, brute_fingerprint(r.text, 3)) for r in odd.collect()]
    parts = brute_parts([r for r in rows if r[0] is not None])
    assert Counter((r.doc_id, r.fingerprint, r.component_id) for r in found) == Counter((i, f"{m:016x}", parts.get(i)) for i, m in rows)
    assert {r.component_id for r in found if r.doc_id in (3, 4, 5)} == {3}
    assert simhash.simhash_duplicates(empty).count() == 0


@pytest.mark.parametrize("tile", [7, 1000])
def test_simhash_against_all_pairs(spark, tile):
    r = random.Random(tile)
    words = [f"w{i}" for i in range(500)]
    base = [[r.choice(words) for _ in range(r.randint(1, 300))] for _ in range(30)]
    rows = []
    for i in range(300):
        text = list(r.choice(base))
        for _ in range(r.randint(0, 2)):
            text[r.randrange(len(text))] = r.choice(words)
        rows.append((i, " ".join(text)))
    found = simhash.simhash_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string"), tile=tile).collect()
    parts = brute_parts([(i, brute_fingerprint(t, 3)) for i, t in rows])
    assert {x.doc_id: x.component_id for x in found} == parts and len(set(parts.values())) < 250


@pytest.mark.parametrize("alike", [False, True])
def test_links_join_what_is_near(spark, monkeypatch, alike):
    r = np.random.default_rng(5)
    marks = r.integers(0, 1 << 63, 400, dtype=np.uint64)
    if alike:  # many fingerprints a few bits from each other, so nearly all pairs are links
        marks = np.array([0x5555 ^ (1 << i) ^ (1 << j) for i in range(20) for j in range(i)], np.uint64)
    else:
        marks = np.unique(np.concatenate([marks, marks ^ np.uint64(0b111), marks ^ np.uint64(0b1111 << 30)]))
    monkeypatch.setattr(simhash, "COMPARED", 64)
    rows = spark.createDataFrame([(int(m),) for m in marks.view(np.int64)], "mark bigint")
    found = simhash.links(rows, tile=50).collect()
    ids = {int(m): i for i, m in enumerate(sorted(marks.tolist()))}
    expected = brute_parts([(i, m) for m, i in ids.items()])
    root = dict.fromkeys(ids.values())
    root.update({i: i for i in root})

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for link in found:
        x, y = (find(ids[v & ((1 << 64) - 1)]) for v in (link.a, link.b))
        root[max(x, y)] = min(x, y)
    assert {i: find(i) for i in root} == expected


def test_shingles_are_hashed_in_blocks(monkeypatch):
    text = "One two three four five six seven eight nine ten " * 40
    whole = simhash.fingerprint(text)
    monkeypatch.setattr(simhash, "BLOCK", 7)
    assert simhash.fingerprint(text) == whole == brute_fingerprint(text, 3)
