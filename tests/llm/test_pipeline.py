"""The pipeline's stages, each against its own input."""

import zlib
from collections import Counter

import corpus_pipeline
import numpy as np
from fixtures import WORD

from etalage.llm.decontaminate import fold_words, item_windows

SF = "/root/testdata/sf0.001"


def test_stages(spark, tmp_path):
    from tokenizers import Tokenizer

    from etalage.llm.queries import word_bpe

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    bench = spark.read.parquet(f"{SF}/benchmark.parquet").collect()
    kept, frames = {}, {}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, SF)
        out.write.parquet(str(tmp_path / name))
        out = spark.read.parquet(str(tmp_path / name))
        if k < 4:
            assert out.columns == docs.columns
        kept[name], frames[name] = {r.doc_id for r in out.select("doc_id").collect()}, out
        docs = out
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    sets = {}
    for d in kept["quality"]:
        ws = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in texts[d]))
        sets[d] = {tuple(ws[i : i + 5]) for i in range(max(1, len(ws) - 4))}
    linked = lambda a, b: 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])
    ids = sorted(kept["near_dedup"])
    assert not any(linked(a, b) for i, a in enumerate(ids) for b in ids[:i])
    for d in kept["quality"] - kept["near_dedup"]:
        assert any(linked(d, x) for x in kept["quality"] if x != d)
    windows = {p for r in bench for p in item_windows(r.text)}
    hit = lambda ws: any(tuple(ws[i : i + 10]) in windows for i in range(len(ws)))
    assert kept["decontamination"] == {d for d in kept["near_dedup"] if not hit(fold_words(texts[d]))}
    assert kept["mixing"] <= kept["decontamination"]
    mixed = Counter(r.doc_id for r in frames["mixing"].collect())
    assert max(mixed.values()) <= 2
    t = Tokenizer.from_file(word_bpe())
    crc = {d: zlib.crc32(np.array([*t.encode(texts[d], add_special_tokens=False).ids, 1], "<u4").tobytes()) for d in mixed}
    assert Counter((r.doc_id, r.ids_crc32) for r in frames["token_files"].collect()) == Counter({(d, crc[d]): n for d, n in mixed.items()})
    whole = corpus_pipeline.run(spark, SF)
    assert sorted(map(tuple, whole.collect())) == sorted(map(tuple, frames["token_files"].collect()))


def test_near_dedup_stage_keeps_rows_not_ids(spark):
    def text(seed):
        rng = np.random.default_rng(seed)
        return [f"w{x}" for x in rng.integers(0, 5000, 120)]

    def near(seed):
        return " ".join([*text(seed)[:-1], "other"])

    def full(seed):
        return " ".join(text(seed))

    rows = [
        (None, full(1), "alone, no id"), (None, full(2), "copy of 7, no id"), (7, full(2), "kept"), (8, near(2), "near copy of 7"),
        (9, full(3), "kept"), (9, full(4), "kept: another text, same id"), (9, near(3), "near copy, same id"), (10, full(5), "one of two"),
        (10, full(5), "one of two"), (None, full(6), "one of two, no id"), (None, full(6), "one of two, no id"),
        (12, near(1), "kept: has an id"), (None, "", "kept: empty"), (13, None, "kept: empty"), (13, "", "kept: empty"),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(4)
    out = corpus_pipeline.near_dedup_stage(spark, docs, SF)
    assert out.columns == docs.columns
    want = [r for r in rows if r[2].startswith("kept")] + [rows[7], rows[9]]
    assert sorted(map(tuple, out.collect()), key=repr) == sorted(want, key=repr)
    assert corpus_pipeline.near_dedup_stage(spark, docs.limit(0), SF).count() == 0


CLASHES = ("src words target mix mix_ _times copy _row row row_ first blocks shards source_words source_size shard before quota own size taken "
           "component_id kept n_words score rules quality dedup hit hits items contamination contaminated start n_tokens part k doc_id_ TEXT_ MIX2 Row2 "
           "own2 _mix_id _mix_src _range _place id ids").split()


def test_every_stage_passes_clashing_columns_nulls_and_ties_through(spark):
    rng = np.random.default_rng(3)

    def text(n, seed):
        r = np.random.default_rng(seed)
        return "\n".join(" ".join(f"w{x}" for x in r.integers(0, 5000, 12)) + "." for _ in range(n))

    base = [(k, text(int(rng.integers(6, 20)), k), "en", f"s{k % 3}") for k in range(60)]
    base += [(None, text(9, 900), "en", None), (None, text(9, 901), None, "s1"), (None, None, "en", "s1"), (70, None, None, None), (71, "", "en", "s2"),
             (72, "  \n ", "en", "s2"), (73, base[3][1], "en", "s0"), base[5], base[5], (5, text(8, 902), "fr", "s2"), (74, "ONE two", "en", "s0"), (75, "w1 " * 9000, "en", "hot")]
    names = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{c} string" for c in CLASHES)
    rows = [(*r, len(r[1] or ""), *[f"{c} of {i}" for c in CLASHES]) for i, r in enumerate(base)]
    docs = spark.createDataFrame(rows, names).repartition(3)
    known = Counter(rows)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns, name
        got = Counter(map(tuple, out.collect()))
        assert got and not set(got) - set(known), name
        if name != "mixing":
            assert all(n <= known[r] for r, n in got.items()), name
    ends = corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect()
    assert len(ends) == len(rows) and Counter(r.doc_id for r in ends) == Counter(r[0] for r in rows)
    nothing = docs.limit(0)
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, nothing, SF).count() == 0, name


def test_mixing_stage_takes_documents_as_often_as_the_mix(spark):
    from etalage.llm.mixing import mix_sources

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    taken = {r.mix.doc_id: r.mix.taken / max(r.mix.size, 1) for r in mix_sources(docs).collect()}
    out = Counter(r.doc_id for r in corpus_pipeline.mixing_stage(spark, docs, SF).select("doc_id").collect())
    assert out == Counter({d: int(t + 0.5) for d, t in taken.items() if int(t + 0.5)})
