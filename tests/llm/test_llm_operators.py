"""Operators against brute force and on odd input."""

import os
import random
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from homematch.llm import components, fingerprint, language_id, license_scan, near_dedup, packing, piece_codec, quality_net, quality_rules, sharding, url_filter

tokenizer_files = pytest.importorskip("public_tokenizers")
PIECES, BYTES = tokenizer_files.path("piece_bpe_32k.model"), tokenizer_files.path("byte_bpe_50k.json")
SMALL = "/root/testdata/sf0.001"
has_data = pytest.mark.skipif(not os.path.isdir(SMALL), reason="test tables are absent")


def brute_components(rows, width):
    sets = [(i, frozenset(near_dedup.shingle_set(t, width).tolist())) for i, t in rows if i is not None]
    root = {i: i for i, _ in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for k, (i, a) in enumerate(sets):
        for j, b in sets[k:]:
            if a and b and 100 * len(a & b) >= 80 * len(a | b):
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    return {i: find(i) for i in root}


def test_near_duplicates_of_odd_rows(odd, empty):
    found = near_dedup.near_duplicates(odd, 2).collect()
    assert len(found) == odd.count()
    expected = brute_components([(r.doc_id, r.text) for r in odd.collect()], 2)
    assert {r.doc_id: r.component_id for r in found if r.doc_id is not None} == expected
    assert all(r.component_id is None and not r.kept for r in found if r.doc_id is None)
    assert {r.doc_id: r.n_shingles for r in found}[8] == 1 and {r.doc_id: r.n_shingles for r in found}[5] == 0
    assert near_dedup.near_duplicates(empty, 2).count() == 0


@pytest.mark.parametrize("width", [2, 5])
def test_near_duplicates_against_all_pairs(spark, width):
    r = random.Random(width)
    words = [f"w{i}" for i in range(300)]
    base = [[r.choice(words) for _ in range(r.randint(20, 200))] for _ in range(40)]
    rows = []
    for i in range(300):
        text = list(r.choice(base))
        for _ in range(r.randint(0, len(text) // 12)):
            text[r.randrange(len(text))] = r.choice(words)
        rows.append((i, " ".join(text)))
    found = near_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string"), width).collect()
    assert {x.doc_id: x.component_id for x in found} == brute_components(rows, width)


def test_near_duplicates_that_agree_in_half_of_the_coordinates(spark):
    seed, texts = 131897, ("a b c d", "a b c d e")
    factors, shifts = near_dedup.coefficients(near_dedup.COORDINATES, seed)
    first, second = (near_dedup.signature(near_dedup.shingle_set(t, 1), factors, shifts) for t in texts)
    assert (first == second).sum() == 34
    found = near_dedup.near_duplicates(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string"), 1, seed).collect()
    assert {r.doc_id: r.component_id for r in found} == {0: 0, 1: 0}


def test_components(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 101), (101, 100), (7, 7)]
    found = {r.node: r.component for r in components.components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    assert found == {**{i: 0 for i in range(41)}, 100: 100, 101: 100}


def executions(spark, work):
    """What ``work`` gives, and how many plans Spark ran for it."""
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30_000)
    store = spark._jsparkSession.sharedState().statusStore()
    before = store.executionsCount()
    found = work()
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30_000)
    return found, store.executionsCount() - before


def test_components_of_stars_need_no_step(spark):
    links = spark.createDataFrame([(5, i) for i in range(6, 60)] + [(3, 4)], "a bigint, b bigint")
    found, ran = executions(spark, lambda: {r.node: r.component for r in components.components(links).collect()})
    assert found == {**{i: 5 for i in range(5, 60)}, 3: 3, 4: 3}
    assert ran == 3


def test_components_extended_by_links(spark):
    r = random.Random(3)
    for kind, name in (("bigint", int), ("string", lambda i: f"n{i:03}")):
        first, second = ([(name(r.randrange(120)), name(r.randrange(120))) for _ in range(n)] for n in (50, 30))
        old, new, both = (spark.createDataFrame(x, f"a {kind}, b {kind}") for x in (first, second, first + second))
        found = components.extended(components.components(old), new).collect()
        assert len({x.node for x in found}) == len(found)
        expected = {x.node: x.component for x in components.components(both).collect()}
        assert {x.node: x.component for x in found if x.node in expected} == expected and {x.node for x in found} <= expected.keys()


def test_near_duplicates_without_candidates_run_few_plans(spark):
    rows = spark.createDataFrame([(i, " ".join(f"w{i}x{k}" for k in range(30))) for i in range(20)], "doc_id bigint, text string")
    found, ran = executions(spark, lambda: near_dedup.near_duplicates(rows).collect())
    assert all(x.kept and x.component_id == x.doc_id for x in found) and len(found) == 20
    assert ran <= 20


def test_quality_net_learns_and_handles_odd_rows(spark, odd, empty):
    r = random.Random(1)
    words = ["green", "house", "by", "the", "river", "and", "hill", "with", "old", "trees"]
    rows = [(i, " ".join(r.choice(words) for _ in range(60)), 1) if i % 2 else (i, " ".join(r.choice(words).upper() + "!!" for _ in range(60)), 0) for i in range(400)]
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, q) for i, _, q in rows], "doc_id bigint, quality int")
    found = quality_net.score_quality(docs, labels).collect()
    held = [x for x in found if x.held_out]
    assert held and all(x.held_out == (zlib.crc32(str(x.doc_id).encode()) % 4 == 2) for x in found)
    assert np.mean([x.predicted == rows[x.doc_id][2] for x in held]) > 0.95
    scores = quality_net.score_quality(odd, labels).collect()
    assert len(scores) == odd.count() and all(0 <= x.score <= 1 for x in scores)
    assert quality_net.score_quality(empty, labels.where("false")).count() == 0


def test_quality_gradients_follow_the_loss():
    net = quality_net.QualityNet.fresh(3)
    data = np.frombuffer(b"some text with a few words in it, more than one chunk " * 8, np.uint8)
    grad = {k: np.zeros(a.shape, np.float64) for k, a in net.w.items()}
    net.gradients(data, 1, grad)

    def loss():
        return -np.log(net.score(data.tobytes().decode()))

    for name, at in (("out", (2,)), ("dense", (5, 3)), ("filters", (3, 4, 1)), ("embed", (ord("w"), 2))):
        old = net.w[name][at]
        net.w[name][at] = old + 1e-2
        up = loss()
        net.w[name][at] = old - 1e-2
        down = loss()
        net.w[name][at] = old
        assert grad[name][at] == pytest.approx((up - down) / 2e-2, rel=0.15, abs=2e-3)


def plain_score(net, text):
    """The forward pass, byte by byte and chunk by chunk."""
    data = (text or "").encode()
    count = max(1, -(-len(data) // quality_net.HALF)) * quality_net.HALF
    data += bytes(count + quality_net.REACH - 1 - len(data))
    answers = []
    for at in range(count):
        total = np.zeros(quality_net.FILTERS)
        for i in range(quality_net.REACH):
            for e in range(quality_net.EMBED):
                total += float(net.w["embed"][data[at + i], e]) * net.w["filters"][i, e]
        answers.append(total)
    halves = [np.max(answers[s:s + quality_net.HALF], axis=0) for s in range(0, count, quality_net.HALF)]
    chunks = [np.maximum(a, b) for a, b in zip(halves, halves[1:])] or halves
    seen = [np.tanh(c + net.w["bias"]) for c in chunks]
    pooled = np.concatenate([np.max(seen, axis=0), np.mean(seen, axis=0)])
    hidden = np.tanh(pooled @ net.w["dense"] + net.w["dense_bias"])
    return 1 / (1 + np.exp(-(hidden @ net.w["out"] + net.w["out_bias"][0])))


def test_quality_scores_against_a_plain_pass():
    net = quality_net.QualityNet.fresh(3)
    for text in ("", None, "a", "Straße " * 30, "x" * 64, "some words, " * 17):
        assert net.score(text) == pytest.approx(float(plain_score(net, text)), abs=1e-5)


def test_shifted_texts_keep_their_decision():
    """Filters stand at every byte, so some blanks in front move a score by little."""
    r = random.Random(2)
    words = ["green", "house", "by", "the", "river", "and", "hill", "with", "old", "trees"]
    texts = [" ".join(r.choice(words) for _ in range(60)) if i % 2 else " ".join(r.choice(words).upper() + "!!" for _ in range(60)) for i in range(60)]
    net = quality_net.fit(texts[:40], [i % 2 for i in range(40)])
    for text in texts[40:]:
        scores = [net.score(" " * shift + text) for shift in range(4)]
        assert max(scores) - min(scores) < 0.05 and len({s >= 0.5 for s in scores}) == 1


def test_blocks_do_not_change_scores(monkeypatch):
    net, text = quality_net.QualityNet.fresh(3), "abc def " * 20_000
    whole = net.score(text)
    monkeypatch.setattr(quality_net, "BLOCK", quality_net.HALF * 4)
    assert net.score(text) == pytest.approx(whole, abs=1e-6)


def test_license_scan(odd, empty):
    found = {r.doc_id: r for r in license_scan.scan_licences(odd).collect()}
    assert (found[6].base_labels, found[6].labels, found[6].n_base, found[6].first_word) == ("mit", "mit", 1, 9)
    assert (found[None].base_labels, found[None].labels) == ("cc-by", "cc-by,cc-by-nc")
    assert found[3].n_words == 0 and found[3].labels == "" and found[3].first_word is None and found[7].n_words == 30_000
    assert license_scan.scan_licences(odd).count() == odd.count() and license_scan.scan_licences(empty).count() == 0


def test_language_identification(spark, odd, empty):
    r = random.Random(5)
    words = {"en": ["the", "house", "with", "thing", "where"], "de": ["das", "haus", "mit", "straße", "über"]}
    rows = [(i, " ".join(r.choice(words[g]) for _ in range(30)), g) for i, g in enumerate(["en", "de"] * 150)]
    found = language_id.identify_languages(spark.createDataFrame(rows, "doc_id bigint, text string, lang string")).collect()
    held = [x for x in found if x.held_out]
    assert held and np.mean([x.lang_pred == rows[x.doc_id][2] for x in held]) > 0.98
    odd_found = language_id.identify_languages(odd).collect()
    assert len(odd_found) == odd.count() and all(x.lang_pred == "und" and x.score == 0 for x in odd_found if x.doc_id in (3, 4, 5))
    assert language_id.identify_languages(empty).count() == 0


@pytest.mark.parametrize(("text", "letter"), [("½ ² ① Ⅷ 12 _ !", False), ("\u0301 \u200b 😀", False), ("½a", True), ("日", True), ("ª", True), ("", False)])
def test_letters(text, letter):
    assert language_id.has_letter(text) == letter
    model = language_id.LanguageModel(["a", "b"], np.ones(language_id.BUCKETS), np.zeros((language_id.BUCKETS, 2)), np.zeros(2), 1.0)
    assert model.predict(text) == (("a", 0.5) if letter else ("und", 0.0))  # equal probabilities: the first name


def plain_ftrl(rows, classes, seed):
    """Follow-the-regularised-leader over dictionaries, one number at a time."""
    z, n, bias, bias_n = {}, {}, [0.0] * classes, [0.0] * classes

    def weight(key):
        value = z.get(key, 0.0)
        if abs(value) <= language_id.L1:
            return 0.0
        return -(value - np.sign(value) * language_id.L1) / ((language_id.BETA + np.sqrt(n.get(key, 0.0))) / language_id.ALPHA + language_id.L2)

    order = np.random.default_rng(seed)
    for _ in range(language_id.EPOCHS):
        for i in order.permutation(len(rows)):
            at, x, label = rows[i]
            held = {(b, c): weight((b, c)) for b in at.tolist() for c in range(classes)}
            scores = [bias[c] + sum(v * held[b, c] for b, v in zip(at.tolist(), x.tolist(), strict=True)) for c in range(classes)]
            top = [np.exp(s - max(scores)) for s in scores]
            for c in range(classes):
                error = top[c] / sum(top) - (c == label)
                for b, v in zip(at.tolist(), x.tolist(), strict=True):
                    g, key = v * error, (b, c)
                    sigma = (np.sqrt(n.get(key, 0.0) + g * g) - np.sqrt(n.get(key, 0.0))) / language_id.ALPHA
                    z[key] = z.get(key, 0.0) + g - sigma * held[key]
                    n[key] = n.get(key, 0.0) + g * g
                bias_n[c] += error * error
                bias[c] -= language_id.ALPHA * error / (language_id.BETA + np.sqrt(bias_n[c]))
    return {key: weight(key) for key in z}, bias


def test_learning_against_plain_ftrl():
    r = random.Random(3)
    texts = [("ab ba abba", 0), ("cd dc cddc", 1), ("ef fe", 2)]
    rows = [(*language_id.weighted(language_id.gram_counts(" ".join(r.choice(t.split()) for _ in range(4))), np.ones(language_id.BUCKETS)), y) for t, y in texts * 6]
    weights, bias = language_id.learned(rows, 3, 1)
    expected, expected_bias = plain_ftrl(rows, 3, 1)
    assert bias == pytest.approx(expected_bias, abs=1e-9) and (weights != 0).sum() == sum(v != 0 for v in expected.values()) > 0
    assert all(weights[key] == pytest.approx(v, abs=1e-9) for key, v in expected.items())


def test_calibration_without_errors_stays_moderate():
    logits = np.array([[4.0, 0.0], [0.0, 4.0]] * 20)
    labels = np.array([0, 1] * 20)
    assert 0.5 < language_id.fitted_temperature(logits, labels) <= 1.05
    assert language_id.fitted_temperature(logits, 1 - labels) > 3


def test_grams_are_counted_over_whole_texts(monkeypatch):
    text = "Straße und Haus " * 50
    whole = language_id.gram_counts(text)
    monkeypatch.setattr(language_id, "BLOCK", 37)
    assert (language_id.gram_counts(text) == whole).all() and whole.sum() == 3 * len(text) - 3


@pytest.mark.parametrize("total", [1, 2, 3, 17, 1000, 4096, 4097])
def test_permutation(total):
    places = sharding.permuted(np.arange(total), total, 9)
    assert sorted(places) == list(range(total))


def test_shards(odd, empty):
    found = sharding.shard_rows(odd, 5, 1).collect()
    slots = {}
    for r in found:
        slots.setdefault(r.shard, []).append(r.slot)
    assert sum(map(len, slots.values())) == odd.count() == len({r.row_number for r in found})
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and max(map(len, slots.values())) - min(map(len, slots.values())) <= 1
    assert {(r.doc_id, r.size, r.text_crc32) for r in found} == {(r.doc_id, len((r.text or "").encode()) + 8, zlib.crc32((r.text or "").encode())) for r in odd.collect()}
    again = sharding.shard_rows(odd.repartition(7), 5, 1).collect()
    assert sorted(map(repr, found)) == sorted(map(repr, again)) and sharding.shard_rows(empty, 5).count() == 0


def test_many_copies_of_one_row_are_numbered_in_runs(spark, monkeypatch):
    rows = spark.range(50).select((F.col("id") % 3 * F.when(F.col("id") < 40, 0).otherwise(1)).alias("v"))
    whole = sorted(map(tuple, sharding.numbered(rows)[0].collect()), key=lambda r: r[1])
    monkeypatch.setattr(sharding, "COPIES", 7)
    assert sorted(map(tuple, sharding.numbered(rows)[0].collect()), key=lambda r: r[1]) == whole
    assert [n for _, n in whole] == list(range(50))


def test_quality_rules(odd, empty):
    found = {r.doc_id: r for r in quality_rules.judge_documents(odd).collect()}
    for row in odd.collect():
        words = (row.text or "").replace("\u3000", "x").split()
        starts = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
        many = {k for k, n in Counter(starts).items() if n > 1}
        covered = {i + k for i, s in enumerate(starts) if s in many for k in range(5)}
        got = found[row.doc_id]
        assert (got.n_words, got.n_repeat_words, got.word_chars) == (len(words), len(covered), sum(map(len, words)))
        assert got.base_failed == (len(words) < 10 or 100 * len(covered) > 20 * len(words))
    assert quality_rules.judge_documents(odd).count() == odd.count() and quality_rules.judge_documents(empty).count() == 0


def test_frequent_lines_go(spark):
    own = [" ".join(chr(97 + i) + chr(97 + k) for k in range(12)) for i in range(9)]
    rows = [(i, f"Common line {i} of ten words that all of the documents share\n{own[i]}", "h") for i in range(8)]
    rows.append((8, f"common  LINE 7 of ten words that all of the documents share\n{own[8]}", "h"))
    rows += [(20, "Common line 1 of ten words that all of the documents share", "h"), (21, "Common line 1 of ten words that all of the documents share", "other")]
    found = {r.doc_id: r for r in quality_rules.judge_documents(spark.createDataFrame(rows, "doc_id bigint, text string, source string"), line_limit=5, with_text=True).collect()}
    assert found[0].kept and found[0].clean_text == own[0]
    assert not found[20].kept and found[20].clean_text == "" and found[21].kept


def test_line_counts_take_copies_as_documents(spark):
    line = "A page made of one template that every copy of it repeats"
    own = [" ".join(chr(97 + i) + chr(97 + k) for k in range(12)) for i in range(6)]
    rows = [(i, line, "copies") for i in range(6)] + [(i, line, "few") for i in range(10, 15)] + [(10, line, "few")]
    rows += [(20, f"{line}\n{o}", "one id") for o in own]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string").repartition(3)
    found = quality_rules.judge_documents(docs, line_limit=5).collect()
    assert len(found) == len(rows)
    assert all((r.kept, r.left_chars) == (False, 0) for r in found if r.doc_id < 6)
    assert all(r.kept and r.left_chars == r.word_chars for r in found if r.doc_id >= 10)


def test_fingerprints(odd, empty):
    found = fingerprint.fingerprint_documents(odd, rows_per_range=2).collect()
    assert len(found) == odd.count()
    rows = sorted(((r.doc_id if r.doc_id is not None else -(1 << 63), r.text or "") for r in odd.collect()))
    expected = Counter()
    for (_, text), (_, following) in zip(rows, rows[1:] + rows[:1], strict=True):
        expected[len(text), fingerprint.edited(text, following)] += 1
    assert Counter((r.n_chars, r.edited) for r in found) == expected
    assert all(r.fingerprint == fingerprint.digest(t.encode()) for r in found for i, t in [(r.doc_id, {a: b for a, b in rows}.get(r.doc_id))] if t is not None)
    assert all(0 <= x <= 1 for r in found for x in (r.near_edited, r.near_next))
    assert fingerprint.fingerprint_documents(empty).count() == 0


def test_likeness_falls_with_edits():
    r = random.Random(4)
    text = "".join(r.choice("abcdefghij klmnop") for _ in range(4000))
    near, far = text[:3800] + "".join(r.choice("zyxw ") for _ in range(200)), "".join(r.choice("qrstuv zyxw") for _ in range(4000))
    a, b, c = (fingerprint.digest(t.encode()) for t in (text, near, far))
    assert fingerprint.likeness(a, a) == 1 and fingerprint.likeness(a, b) > fingerprint.likeness(a, c)


RULES = (("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/es/"))


@pytest.mark.parametrize(("url", "host", "path", "rule", "verdict"), [
    ("http://A.Example.COM/en/x?y#z", "a.example.com", "/en/x", "example.com/en/", "block"),
    ("https://www.example.com/en/", "www.example.com", "/en/", "www.example.com/en/", "allow"),
    ("http://b.com?q=/en/", "b.com", "", None, "allow"),
    ("x://net/es/a://com/", "net", "/es/a://com/", "net/es/", "block"),
    ("no scheme", "", "", None, "allow"), (None, "", "", None, "allow"), ("http://notexample.com/en/", "notexample.com", "/en/", "com/", "allow"),
])
def test_urls(spark, url, host, path, rule, verdict):
    pages = spark.createDataFrame([(1, url, "x"), (1, url, "x")], "page_id bigint, url string, host string")
    found = url_filter.judge_urls(pages, RULES).collect()
    assert found == [(1, host, path, rule, verdict)] * 2
    assert url_filter.judge_urls(pages.where("false"), RULES).count() == 0


def test_cascade_is_exact(spark):
    universe = spark.range(5000).select(F.concat(F.lit("k"), "id").alias("key"), (F.col("id") % 37 == 0).alias("listed"))
    levels = url_filter.cascade(universe)
    assert len(levels) > 1
    wrong = url_filter.with_filters(universe, levels).where(url_filter.is_listed(levels, F.col("key")) != F.col("listed"))
    assert wrong.count() == 0


def test_listed_hosts_decide_where_no_rule_fits(spark):
    urls = [f"http://h{i}.org/x" for i in range(300)] + ["http://h3.com/", "http://h5.example.com/en/", None, ""]
    pages = spark.createDataFrame([(i, u) for i, u in enumerate(urls)], "page_id int, url string")
    listed = spark.createDataFrame([(f"h{i}.org",) for i in range(0, 300, 7)] + [("h3.com",), ("absent.org",)], "host string")
    found = {r.page_id: r.verdict for r in url_filter.judge_urls(pages, RULES, listed).collect()}
    assert [found[i] for i in range(300)] == ["block" if i % 7 == 0 else "allow" for i in range(300)]
    assert [found[300 + i] for i in range(4)] == ["allow", "block", "allow", "allow"]


def test_packing(odd, empty):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(BYTES)
    found = packing.pack_documents(odd, BYTES, size=256, keep=2, group=2).collect()
    used = {}
    for r in sorted(found, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == used.get(r.sequence_id, 0) and len(r.ids) == 4 * r.length
        used[r.sequence_id] = r.offset + r.length
    assert max(used.values()) <= 256
    expected = Counter()
    for row in odd.collect():
        ids = [*library.encode(row.text or "", add_special_tokens=False).ids, 0]
        for start in range(0, len(ids), 256):
            expected[row.doc_id, start, len(ids), np.array(ids[start:start + 256], "<u4").tobytes()] += 1
    assert Counter((r.doc_id, r.start, r.doc_tokens, bytes(r.ids)) for r in found) == expected
    assert packing.pack_documents(empty, BYTES).count() == 0


def odd_texts(count, seed):
    r = random.Random(seed)
    parts = ["a", "e", " ", "  ", "\n", "'s", "th", "é", "\x1c", "\x85", ".", "1", "\t", "\r\n", "日", "\U0001F600", "$ ", "\x00", "<|endoftext|>", "▁", "ß", "The", "<0x41>", "\u200b", "\u2003"]
    return ["".join(r.choice(parts) for _ in range(r.randint(0, 40))) for _ in range(count)] + [" " * n + tail for n in range(0, 200, 7) for tail in ("", "w", "\U0001F600")]


def test_unit_tokenizer_equals_the_library():
    from tokenizers import Tokenizer

    library, own, texts = Tokenizer.from_file(BYTES), packing.UnitTokenizer(BYTES), odd_texts(3000, 1)
    assert [np.frombuffer(x, "<u4").tolist() for x in own.encode(texts)] == [library.encode(t, add_special_tokens=False).ids for t in texts]


def test_unit_tokenizer_keeps_nothing_of_texts():
    own = packing.UnitTokenizer(BYTES)
    own.encode(["a b"])
    tracemalloc.start()
    try:
        for start in range(0, 100_000, 1000):
            assert len(own.encode([" ".join(f"w{i:x}" for i in range(start, start + 1000))])) == 1
        assert tracemalloc.get_traced_memory()[0] < 1_000_000
    finally:
        tracemalloc.stop()


def test_piece_codec_equals_the_library(odd, empty):
    import sentencepiece

    library, own = sentencepiece.SentencePieceProcessor(model_file=PIECES), piece_codec.PieceCodec(piece_codec.load_pieces(PIECES))
    for text in [*odd_texts(3000, 2), *[r.text or "" for r in odd.collect()]]:
        ids = own.encode(text)
        assert ids.tolist() == library.encode(text) and own.decode(ids) == library.decode(ids.tolist())
    found = Counter((r.doc_id, tuple(r.ids), r.decoded) for r in piece_codec.encode_documents(odd, PIECES).collect())
    assert found == Counter((r.doc_id, tuple(library.encode(r.text or "")), library.decode(library.encode(r.text or ""))) for r in odd.collect())
    assert piece_codec.encode_documents(empty, PIECES).count() == 0


def test_other_piece_models_raise(tmp_path):
    from sentencepiece import sentencepiece_model_pb2 as layout

    for change in ("normaliser", "kind", "blanks"):
        spec = layout.ModelProto.FromString(open(PIECES, "rb").read())
        if change == "normaliser":
            spec.normalizer_spec.name = "nmt_nfkc"
        elif change == "kind":
            spec.trainer_spec.model_type = spec.trainer_spec.UNIGRAM
        else:
            spec.normalizer_spec.remove_extra_whitespaces = True
        (tmp_path / change).write_bytes(spec.SerializeToString())
        with pytest.raises(ValueError):
            piece_codec.load_pieces(str(tmp_path / change))


def test_near_duplicates_of_ids_with_several_texts(spark):
    long = " ".join(f"w{i}" for i in range(200))
    rows = [(5, long), (5, "another text of its own"), (3, long + " w"), (4, "another text of its own"), (9, "nothing like it at all"), (9, "nothing like it at all")]
    found = near_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string"), 2).collect()
    assert {(r.doc_id, r.component_id) for r in found} == {(3, 3), (4, 3), (5, 3), (9, 9)} and len(found) == 6


def test_rows_of_arrays_and_files_of_ids_are_not_broadcast(spark):
    from homematch.llm import components

    sets = spark.createDataFrame([(i, [j % 7 for j in range(64)]) for i in range(3)], "rep bigint, signature array<int>")
    held = near_dedup.prefixes(sets)
    pairs = spark.createDataFrame([(1, 2, 0), (2, 3, 0), (4, 5, 0)], "a bigint, b bigint, apart int")
    parts = spark.createDataFrame([(1, 1), (2, 1)], "node bigint, component bigint")
    frames = [held, near_dedup.listed(held), near_dedup.still_apart(pairs, parts), components.extended(parts, pairs.select("a", "b"))]
    for df in frames:
        assert "Broadcast" not in df._jdf.queryExecution().executedPlan().toString()
    assert held.count() == 3 and frames[1].count() == 3 * 33
    assert {(r.a, r.b) for r in frames[2].collect()} == {(2, 3), (4, 5)}
    assert {tuple(r) for r in frames[3].collect()} == {(1, 1), (2, 1), (3, 1), (4, 4), (5, 4)}


def test_parities_never_exceed_the_difference():
    r = random.Random(7)
    for _ in range(200):
        a, b = ({r.randrange(1 << 64) for _ in range(r.randint(0, 700))} for _ in range(2))
        b |= set(list(a)[: r.randint(0, 700)])
        marks = [near_dedup.parities(np.array(sorted(x), np.uint64)).view(np.uint64) for x in (a, b)]
        assert int(np.bitwise_count(marks[0] ^ marks[1]).sum()) <= len(a ^ b)


def test_copies_over_the_line_limit_in_sql(spark):
    import duckdb

    from homematch.llm import queries

    line = "A page made of one template that every copy of it repeats"
    rows = [(i, line, "copies") for i in range(quality_rules.LINE_LIMIT + 10)] + [(1000 + i, line, "few") for i in range(5)] + [(None, line, "none"), (1000, line, "few")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    con = duckdb.connect()
    con.register("documents", docs.toPandas().astype({"doc_id": "Int64"}))
    cursor = con.execute(queries.CHECKS["op6_quality_rules"])
    names = [d[0] for d in cursor.description]
    expected = Counter(map(tuple, cursor.fetchall()))
    assert Counter(tuple(r[n] for n in names) for r in quality_rules.judge_documents(docs).collect()) == expected
    assert sum(n for row, n in expected.items() if not row[names.index("kept")]) == quality_rules.LINE_LIMIT + 10


def test_pipeline_keeps_every_clean_text(spark):
    import corpus_pipeline

    own = [" ".join(f"{c}{i}" for i in range(40)) for c in "abcde"]
    rows = [(1, own[0]), (2, own[1]), (2, own[2]), (None, own[3]), (None, own[4]), (None, own[4]), (7, own[0] + " end"), (2, own[0] + " more"), (8, own[1])]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t), "x", "y") for i, t in rows], "doc_id bigint, text string, lang string, source string, n_chars bigint, row_key string, _id string")
    left = corpus_pipeline.without_near_duplicates(spark, docs, "")
    assert left.columns == docs.columns
    kept = sorted((r.text, r.doc_id is None) for r in left.collect())
    assert [t for t, _ in kept] == sorted(own) and {r.row_key + r._id for r in left.collect()} == {"xy"}


@has_data
def test_pipeline(spark, odd, empty, tmp_path):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    kept = docs
    for _, stage in corpus_pipeline.STAGES[:3]:
        kept = stage(spark, kept, SMALL)
        assert kept.columns == docs.columns
    left = {r.doc_id for r in kept.select("doc_id").collect()}
    assert 0 < len(left) < docs.count()
    pieces = corpus_pipeline.run(spark, SMALL)
    assert {r.doc_id for r in pieces.select("doc_id").distinct().collect()} == left
    for rows in (odd, empty):
        for _, stage in corpus_pipeline.STAGES:
            assert stage(spark, rows, SMALL).count() <= 10 * rows.count() + 1000
