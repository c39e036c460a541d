"""Substring dedup, near dedup, decontamination and quality counts against brute force."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from fixtures import WORD, corpus, documents, empty, lower_az, rows_of

from etalage.llm import decontaminate, near_dedup, quality_forest, substring_dedup
from etalage.llm.graph import components
from etalage.llm.words import Words, run_hashes, runs_within, shingles


def test_words_are_those_of_the_pattern():
    texts = [None, "", " ", "a", "  a\tb\x0bc ", "é\u00a0è x", "x" * 500 + " y", "a\x00b a", "\x1cq r", "end "]
    w = Words(pa.array(texts))
    raw = w.word_bytes()
    got = [[x.decode() for x in raw[w.bounds[i] : w.bounds[i + 1]]] for i in range(len(texts))]
    assert got == [WORD.findall(t or "") for t in texts]
    sliced = Words(pa.array(texts).slice(3, 5))
    assert [x.decode() for x in sliced.word_bytes()] == sum(got[3:8], [])


def test_word_hashes_depend_on_the_word_only():
    texts = ["a b a\x00 a", "b" * 65 + " " + "b" * 65 + " " + "b" * 66, "zz " * 200_000 + "a"]
    w = Words(pa.array(texts))
    by = defaultdict(set)
    for word, h in zip(w.word_bytes(), w.hashes().tolist(), strict=True):
        by[word].add(h)
    assert all(len(v) == 1 for v in by.values()) and len({min(v) for v in by.values()}) == len(by)


def test_runs_stay_inside_a_text():
    w = Words(pa.array(["a b c", "d", "", "a b c d"]))
    at = runs_within(w.bounds, 3)
    assert at.tolist() == [0, 4, 5]
    assert run_hashes(w.hashes(), 3)[0] == run_hashes(w.hashes(), 3)[4]
    values, bounds = shingles(w, 3)
    assert np.diff(bounds).tolist() == [1, 1, 0, 2]


def brute_removed(rows, window=13):
    words = [WORD.findall(t or "") for _, t, _ in rows]
    least = {}
    for (doc, _, _), ws in zip(rows, words, strict=True):
        for i in range(len(ws) - window + 1):
            key, rank = tuple(ws[i : i + window]), (doc is not None, doc or 0)
            least[key] = min(least.get(key, rank), rank)
    out = []
    for (doc, _, _), ws in zip(rows, words, strict=True):
        gone = set()
        for i in range(len(ws) - window + 1):
            if least[tuple(ws[i : i + window])] < (doc is not None, doc or 0):
                gone.update(range(i, i + window))
        kept = " ".join(w for i, w in enumerate(ws) if i not in gone)
        out.append((doc, len(ws), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("bucket_windows", [substring_dedup.BUCKET_WINDOWS, 500])
def test_substring_dedup(spark, bucket_windows):
    rows = corpus()
    got = substring_dedup.removal_intervals(documents(spark, rows).repartition(5), bucket_windows=bucket_windows)
    assert rows_of(got.select("doc_id", "n_words", "n_removed", "kept_sha256")) == brute_removed(rows)
    for r in got.collect():
        spans = np.frombuffer(r.spans, "<i4").reshape(-1, 2)
        assert (spans[:, 1] - spans[:, 0]).sum() == r.n_removed
        assert (spans[1:, 0] > spans[:-1, 1]).all()


def test_substring_dedup_of_nothing(spark):
    assert substring_dedup.removal_intervals(empty(spark)).count() == 0


def test_windows_decided_within_a_batch():
    h = np.array([5, 5, 7, 5, 7, 5, 5], np.uint64)
    ids = np.array([1, 1, 1, 2, 2, 2, 3])
    first, later = substring_dedup.first_of_each(h, ids)
    assert first.tolist() == [0, 2]
    assert sorted((int(h[i]), int(ids[i])) for i in later) == [(5, 2), (5, 3), (7, 2)]
    big = np.array([-(2**63), -5, -5, 0, 2**62, 2**63 - 1])
    assert substring_dedup.unpack_runs(*substring_dedup.pack_runs(big)).tolist() == big.tolist()


def shingle_set(text, size):
    ws = WORD.findall(lower_az(text or ""))
    return {tuple(ws[i : i + size]) for i in range(max(1, len(ws) - size + 1))} if ws else set()


def brute_groups(rows, size=4, percent=80):
    sets = []
    for _, text, _ in rows:
        sets.append(shingle_set(text, size))
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            a, b = sets[i], sets[j]
            linked = a and b and 100 * len(a & b) >= percent * len(a | b)
            if (rows[i][0] is None or rows[j][0] is None) and a != b:
                linked = False
            if linked:
                parent[root(i)] = root(j)
    least = {}
    for i, (doc, _, _) in enumerate(rows):
        if doc is not None:
            least[root(i)] = min(least.get(root(i), doc), doc)
    out = []
    for i, (doc, _, _) in enumerate(rows):
        c = least.get(root(i)) if sets[i] else doc
        out.append((doc, len(sets[i]), c, doc is not None and doc == c))
    return sorted(out, key=repr)


@pytest.mark.parametrize("size", [4, 5])
def test_near_dedup(spark, size):
    rows = corpus()
    got = near_dedup.group_near_duplicates(documents(spark, rows).repartition(4), shingle=size)
    assert rows_of(got) == brute_groups(rows, size)


def test_near_dedup_needs_several_pivots(spark):
    """A chain: each text is linked to its neighbours only."""
    words = [f"w{i}" for i in range(400)]
    rows = [(k, " ".join(words[7 * k : 7 * k + 120]), "a") for k in range(38)]
    assert rows_of(near_dedup.group_near_duplicates(documents(spark, rows))) == brute_groups(rows)


def template(n, seed=5, common=100, own=(12, 27)):
    """Texts of one template with words of their own, similar at 0.65 to 0.9; a few near copies of some, one text without id."""
    rng = random.Random(seed)
    base = [f"t{i}" for i in range(common)]
    rows = [(k, " ".join(base + [f"o{k}x{i}" for i in range(rng.randrange(*own))]), "a") for k in range(n)]
    for k in range(0, n, 9):
        words = rows[k][1].split()
        rows += [(1000 + 20 * k + j, " ".join([*words[:-2], f"c{k}x{j}", *words[-1:]]), "b") for j in range(rng.choice((1, 1, 12)))]
    return [*rows, (5000, " ".join(base[:50] + [f"z{i}" for i in range(80)]), "c"), (None, rows[1][1], "d")]


@pytest.mark.parametrize(("own", "size"), [((12, 27), 4), ((1, 40), 4), ((30, 31), 5)])
def test_near_dedup_of_a_template(spark, own, size):
    """Large buckets of texts that are linked, just not linked, and linked by a third one."""
    rows = template(70, own=own)
    got = near_dedup.group_near_duplicates(documents(spark, rows), shingle=size, pivots=5)
    assert rows_of(got) == brute_groups(rows, size)


def test_rare_shingles_meet_for_every_link(spark):
    """The prefix filter alone gives all links, also of sets of very different sizes."""
    rng = random.Random(2)
    rows = [r for r in template(60, own=(1, 40)) if r[0] is not None]
    rows += [(2000 + k, " ".join(f"v{rng.randrange(12)}" for _ in range(rng.randrange(1, 40))), "e") for k in range(60)]
    sets = {d: shingle_set(t, 2) for d, t, _ in rows}
    texts = documents(spark, rows).selectExpr("doc_id AS node", "text")
    found = near_dedup.rare_shingles(texts, 2, 80).selectExpr("token", "node", "size", "short", "node AS component", "1L AS n")
    pairs = {(r.a, r.b) for r in near_dedup.rare_pairs(found, 80).collect()}
    links = {(a, b) for a in sets for b in sets if a < b and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])}
    assert links and links <= pairs
    assert len(pairs) < len(sets) * (len(sets) - 1) / 4


def test_near_dedup_of_nothing(spark):
    assert near_dedup.group_near_duplicates(empty(spark)).count() == 0
    only_empty = documents(spark, [(1, None, "a"), (2, "", None)])
    assert rows_of(near_dedup.group_near_duplicates(only_empty)) == [(1, 0, 1, True), (2, 0, 2, True)]


def test_tensored_recall():
    """Pairs at the threshold share a table key, and half keys are few."""
    rng = np.random.default_rng(1)
    found = 0
    for _ in range(300):
        common, a, b = (rng.integers(0, 1 << 63, n, dtype=np.uint64) for n in (400, 50, 50))
        values = np.concatenate([np.sort(np.concatenate((common, x))) for x in (a, b)])
        keys = near_dedup.half_keys(values, np.array([0, 450, 900]), 20, 2, 11)
        same = keys[0] == keys[1]
        found += bool(same[:10].any() and same[10:].any())
    assert found >= 299


def test_components(spark):
    edges = [(i, i + 1) for i in range(50)] + [(100, 101), (103, 102), (101, 102), (7, 7)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(51)}, **{i: 100 for i in range(100, 104)}}


def fold(text):
    return decontaminate.fold_words(text)


def brute_hits(rows, items):
    out = []
    windows = defaultdict(set)
    for item, text in items:
        for p in decontaminate.item_windows(text):
            windows[p].add(item)
    for doc, text, _ in rows:
        ws, hit, ids = fold(text), set(), set()
        for p, of in windows.items():
            for i in range(len(ws) - len(p) + 1):
                if tuple(ws[i : i + len(p)]) == p:
                    hit.update(range(i, i + len(p)))
                    ids |= {str(x) for x in of if x is not None}
        out.append((doc, len(ws), len(hit), sorted(ids), bool(hit)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("block_words", [decontaminate.BLOCK_WORDS, 60])
def test_decontamination(spark, block_words):
    rows = corpus()
    passage = next(t for d, t, s in rows if d is None and t)
    items = [(1, passage), (2, None), (3, ""), (4, "ONE!"), (None, "w1 w2"), (5, passage[40:].upper()), (5, "n1 n2 n3"), (10, "a a a a a a a a a a a")]
    rows += [(400, "a " * 30, "x"), (401, "w1 w2, w1\tw2", "x")]
    bench = spark.createDataFrame([(i, t, "extra") for i, t in items], "item_id long, text string, doc_id string")
    got, name = decontaminate.find_contamination(documents(spark, rows), bench, keep=["doc_id"], block_words=block_words)
    assert name == "contamination"
    assert rows_of(got.select("doc_id", *[f"{name}.{c}" for c in ("n_words", "n_hit", "items", "contaminated")])) == brute_hits(rows, items)
    kept, name = decontaminate.find_contamination(documents(spark, rows), bench)
    assert name == "contamination_" and len(kept.columns) == 10 and kept.count() == len(rows)


def test_benchmark_blocks_are_made_in_spark(spark):
    items = [(k % 40, " ".join(f"w{(k * 7 + j) % 90}" for j in range(5 + k % 20))) for k in range(60)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    blocks, n = decontaminate.pattern_blocks(bench, "item_id", "text", 10, 50)
    rows = blocks.collect()
    assert n > 15 and {r.block for r in rows} <= set(range(n)) and len({bytes(r.pattern) for r in rows}) == len(rows)
    want = {p for _, t in items for p in decontaminate.item_windows(t)}
    assert {tuple(bytes(r.pattern).split(b" ")) for r in rows} == want
    size = [sum(len(bytes(r.pattern).split(b" ")) for r in rows if r.block == k) for k in range(n)]
    assert max(size) < 60
    assert len(decontaminate.load_block(blocks, 3)[1]) == sum(r.block == 3 for r in rows)


def test_decontamination_without_items_or_documents(spark):
    bench = spark.createDataFrame([], "item_id long, text string")
    got, name = decontaminate.find_contamination(documents(spark, corpus()), bench)
    assert got.where(f"{name}.contaminated").count() == 0
    assert decontaminate.find_contamination(empty(spark), bench)[0].count() == 0


def test_wu_manber_skips():
    looked = []

    class Seen(list):
        def __getitem__(self, k):
            looked.append(k)
            return super().__getitem__(k)

    words = Seen(fold("z" + " z" * 999))
    assert list(decontaminate.WuManber([tuple(fold("a b c d e f g h i j"))]).search(words)) == []
    assert len(looked) < 130


def brute_counts(text):
    ws = WORD.findall(text or "")
    seen = Counter(tuple(ws[i : i + 8]) for i in range(len(ws) - 7))
    hit = set()
    for i in range(len(ws) - 7):
        if seen[tuple(ws[i : i + 8])] > 1:
            hit.update(range(i, i + 8))
    lines, dup = set(), 0
    for line in (text or "").split("\n"):
        if WORD.search(line):
            dup += line in lines
            lines.add(line)
    return len(ws), sum(map(len, ws)), sum(c in "#*$%&|<>" for c in text or ""), dup, len(hit)


def test_rule_counts():
    rows = [t for _, t, _ in corpus()] + ["a b\na b\n\n \n \na b", "é#é *|\n<>&$%", "r s t u v w x y z " * 9, "\x0c\n\x0c\n q"]
    stats, features = quality_forest.rule_statistics(pa.array(rows, pa.string()))
    got = list(zip(*[stats[c].tolist() for c in quality_forest.COUNTS], strict=True))
    assert got == [brute_counts(t) for t in rows]
    assert np.isfinite(features).all()


def test_forest_isolates_outliers():
    rng = np.random.default_rng(5)
    good = rng.normal(0, 1, (4000, 9))
    forest = quality_forest.IsolationForest.grow(good[:2000])
    odd = good[2000:2100].copy()
    odd[:, 3] += 15
    assert np.quantile(forest.score(good[2000:]), 0.99) < np.quantile(forest.score(odd), 0.05)
    good_bins, bad_bins = np.zeros(10), np.zeros(10)
    good_bins[[2, 5]], bad_bins[8] = (90, 10), 7
    assert 0.6 <= quality_forest.threshold_of(good_bins, bad_bins, 0.995) <= 0.8


def test_quality_edge_cases(spark):
    rows = corpus()
    docs = documents(spark, rows)
    labels = spark.createDataFrame([(None, 1, 0), (10, None, 0), (11, 0, 1), (999, 1, 0)] + [(k, 1, 0) for k in range(12, 60)],
                                   "doc_id long, quality int, toxic int")
    got, name = quality_forest.judge_quality(docs, labels)
    assert name == "rules_" and got.count() == len(rows)
    for r in got.collect():
        if r[name].base_failed:
            assert not r[name].kept
    none, name = quality_forest.judge_quality(docs, labels.where("quality = 0"))
    assert none.where(f"{name}.kept = {name}.base_failed").count() == 0
    assert quality_forest.judge_quality(empty(spark), labels)[0].count() == 0


def test_quality_on_held_out_labels(spark):
    """Fitted on half of the labels: the other half's junk goes, its good documents stay."""
    sf = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    got, name = quality_forest.judge_quality(docs, labels.where("doc_id % 2 = 0"), keep=["doc_id"])
    held = got.join(labels.where("doc_id % 2 = 1"), "doc_id").groupBy("quality", f"{name}.kept").count().collect()
    n = {(r.quality, r.kept): r["count"] for r in held}
    good, bad = n.get((1, True), 0) / (n.get((1, True), 0) + n.get((1, False), 0)), n.get((0, False), 0) / (n.get((0, True), 0) + n.get((0, False), 0))
    assert good > 0.97 and bad > 0.8, (good, bad)
