"""Order MinHash fingerprints, conversation repair and hard negatives against brute force."""

import hashlib
import itertools
import random
import re
import struct
import zlib

import pytest
import xxhash
from fixtures import corpus, documents, rows_of
from pyspark.sql import functions as F

from etalage.llm import conversation_repair as cr
from etalage.llm import hard_negatives as hn
from etalage.llm import order_minhash as om
from etalage.llm.queries import damaged

# ---------------------------------------------------------------- fingerprints

MASK = (1 << 64) - 1


def signed(x):
    return x - (1 << 64) if x >= 1 << 63 else x


def xx(*values):
    h = 42
    for v in values:
        if v is not None:
            raw = v.encode() if isinstance(v, str) else struct.pack("<i" if isinstance(v, I32) else "<q", v)
            h = xxhash.xxh64_intdigest(raw, h)
    return signed(h)


class I32(int):
    pass


def brute_signature(text):
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", re.sub(om.ALONE, r" \1 ", text or "")) if w]
    if not words:
        return []
    seen, ring = {}, []
    for i in range(max(len(words) - om.K + 1, 1)):
        gram = xx(*words[i : i + om.K]) >> om.BITS
        n = seen[gram] = seen.get(gram, -1) + 1
        h = xx(gram, I32(n)) >> om.BITS
        ring.append((h, i + 1))
    ring.sort()
    out = []
    for j in range(om.COMPONENTS):
        start = (j * (1 << 64) // om.COMPONENTS - (1 << 63)) >> om.BITS
        at = next((k for k, (h, _) in enumerate(ring) if h >= start), len(ring))
        chosen = [ring[(at + t) % len(ring)] for t in range(min(om.TUPLE, len(ring)))]
        hashes = [(h & ((1 << 64 - om.BITS) - 1)) >> 1 for h, _ in sorted(chosen, key=lambda e: e[1])]
        out.append((xx(*hashes) >> 32) & 0xFFFFFFFF)
    return out


def brute_like(a, b):
    if not a or not b:
        return float(len(a) == len(b))
    return sum(x == y for x, y in zip(a, b, strict=True)) / len(a)


def brute_fingerprints(rows):
    """Rows of (doc_id, text), which has no two different texts of one id."""
    rows = sorted(((d, t or "") for d, t in rows), key=lambda r: (r[0] is None, r[0] or 0, xx(r[1])))
    out = []
    for k, (d, t) in enumerate(rows):
        after = rows[(k + 1) % len(rows)][1]
        half = len(t) // 2
        edited = t[: len(t) - half] + after[:half]
        a, b, c = brute_signature(t), brute_signature(edited), brute_signature(after)
        text = ["".join(f"{x:08x}" for x in s) for s in (a, b)]
        out.append((d, len(t), edited, *text, brute_like(a, b), brute_like(a, c)))
    return sorted(out, key=repr)


def test_fingerprints(spark):
    rows = [(d, t) for d, t, _ in corpus()]
    rows += [(400, "日本語 のテキスト。かな混じり文"), (401, "日本語 のテキスト。かな混じり文"), (402, " \t\n "), (403, "a b a b a b a b a b a b"), (404, "\U0001f600 é \U00020001x")]
    docs = documents(spark, [(d, t, "s") for d, t in rows])
    got = om.fingerprints(docs.repartition(5))
    assert got.columns == ["doc_id", "n_chars", "edited", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    assert rows_of(got) == brute_fingerprints(rows)


def test_fingerprints_follow_order_and_edits(spark):
    rng = random.Random(5)
    words = [f"w{i}" for i in range(400)]
    moved = words[200:] + words[:200]
    few = list(words)
    for i in rng.sample(range(400), 4):
        few[i] = f"z{i}"
    texts = {"same": words, "few": few, "moved": moved, "shuffled": rng.sample(words, 400), "other": [f"q{i}" for i in range(400)]}
    one = brute_signature(" ".join(words))
    like = {k: brute_like(one, brute_signature(" ".join(v))) for k, v in texts.items()}
    assert like["same"] == 1 and like["few"] > 0.85 and 0.2 < like["moved"] < 0.8 and like["shuffled"] < 0.1 and like["other"] == 0
    table = spark.createDataFrame([(k, " ".join(v)) for k, v in texts.items()], "name string, text string")
    got = {r[0]: r[1] for r in table.select("name", om.fingerprint(F.col("text"))).collect()}
    assert {k: brute_like(got["same"], v) for k, v in ((k, got[k]) for k in texts)} == like


@pytest.mark.parametrize("rows", [[], [(1, "one two three four")], [(None, None)], [(7, "same")] * 40, [(None, "x y z w")] * 30 + [(1, "")]])
def test_fingerprints_of_odd_tables(spark, rows):
    docs = documents(spark, [(d, t, "s") for d, t in rows])
    assert rows_of(om.fingerprints(docs)) == brute_fingerprints(rows)


def test_next_documents_over_many_blocks(spark):
    rng = random.Random(1)
    ids = [rng.choice([None, rng.randrange(1000), 5]) for _ in range(900)]
    docs = spark.createDataFrame([(d, f"t{rng.randrange(40)}") for d in ids], "doc_id long, text string").repartition(7).cache()
    docs.count()
    for blocks in (1, 3, 64, 5000):
        got = om.with_next(docs, blocks=blocks).select("own.doc_id", "own.text", "next.text").collect()
        order = sorted(((r.doc_id, r.text) for r in docs.collect()), key=lambda r: (r[0] is None, r[0] or 0, xx(r[1])))
        want = sorted(((*r, order[(k + 1) % len(order)][1]) for k, r in enumerate(order)), key=repr)
        assert sorted((tuple(r) for r in got), key=repr) == want


def test_fingerprints_are_native(spark):
    plan = om.fingerprints(documents(spark, [(1, "a b c", "s")]))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


# ---------------------------------------------------------------- conversations

SPACES = " \t\n\x0b\x0c\r"


def brute_faults(rows):
    seen, out = set(), []
    for role, text in rows:
        body = text.strip(SPACES)
        if not body:
            out.append("blank")
        elif (role, text) in seen:
            out.append("duplicate")
        else:
            out.append("truncated" if body[-1] not in ".!?" else "none")
        seen.add((role, text))
    return out


def brute_audit(roles, found):
    """The least (cost, audit): all role strings so far, not states."""
    best = {("", 0): (0, "")}

    def legal(s):
        return re.fullmatch(r"(s?(ua)*u?)?", s) is not None

    def relax(table, key, value):
        if key not in table or value < table[key]:
            table[key] = value

    # of a role string only its end matters from here on
    known, short = {"xu": "u", "xua": "ua"}, {"u": "xu", "ua": "xua", "uau": "xu", "su": "xu"}

    def grown(table):
        todo = list(table.items())
        while todo:
            (s, i), (cost, audit) = todo.pop()
            for c in "ua":
                full = known.get(s, s) + c
                if legal(full):
                    key, value = (short.get(full, full), i), (cost + 5, audit + "I")
                    if len(audit) - len(audit.rstrip("I")) < 3 and (key not in table or value < table[key]):
                        table[key] = value
                        todo.append((key, value))
        return table

    for i, (role, fault) in enumerate(zip(roles, found, strict=True)):
        after = {}
        for (s, _), (cost, audit) in grown(best).items():
            relax(after, (s, i + 1), (cost + 2, audit + "D"))
            if fault in ("blank", "duplicate"):
                continue
            more = 5 if fault == "truncated" else 0
            for letter, extra, c in [("K", 0, role[:1]), ("R", 1, "u"), ("R", 1, "a")]:
                full = known.get(s, s) + c
                if c and c in "sua" and (c != "s" or s == "") and legal(full):
                    relax(after, (short.get(full, full), i + 1), (cost + extra + more, audit + letter))
        best = after
    ends = [v for (s, _), v in grown(best).items() if s in ("", "xua")]
    return min(ends)


def brute_repaired(audit, rows):
    out, k, opened = [], 0, False
    for letter in audit:
        if letter != "I":
            role, text = rows[k]
            k += 1
        if letter == "D":
            continue
        turn = len(out) - (1 if opened else 0)
        if letter == "K":
            opened = opened or (not out and role[:1] == "s")
            out.append((role, text))
        else:
            out.append(("user" if turn % 2 == 0 else "assistant", "" if letter == "I" else text))
    return out


def brute_conversation(rows):
    """rows: (turn, role, text) of one conversation, after damage."""
    rows = sorted(((t, " " if r is None else r, " " if x is None else x) for t, r, x in rows),
                  key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.md5(r[2].encode()).hexdigest()))
    pairs = [(r, x) for _, r, x in rows]
    found = brute_faults(pairs)
    cost, audit = brute_audit([r for r, _ in pairs], found) if rows else (0, "")
    known = [t for t, _, _ in rows if t is not None]
    initials = [r[:1] for r, _ in pairs]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in itertools.pairwise(initials))
    text = "\n".join(f"{r}:{x}" for r, x in brute_repaired(audit, pairs))
    return (max(known) - min(known) + 1 - len(set(known)) if known else 0, found.count("blank"), found.count("duplicate"), found.count("truncated"),
            illegal, cost, audit, hashlib.sha256(text.encode()).hexdigest())


def brute_damage(rows):
    out = []
    for c, t, r, x in rows:
        kind = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        r, x = " " if r is None else r, " " if x is None else x
        x = "" if kind == 1 else re.sub("[.!?]", "", x) if kind == 2 else x
        out += [(c, t, "user" if kind == 4 else r, x)] * {0: 0, 3: 2}.get(kind, 1)
    return out


def chats(seed=2, conversations=160):
    rng = random.Random(seed)
    rows = []
    for c in range(conversations):
        c = None if c == 0 else c
        for _ in range(rng.randrange(1, 14)):
            turn = rng.choice([None, rng.randrange(8), rng.randrange(30)])
            rows.append((c, turn, rng.choice(["user", "assistant", "system", "tool", "", None, "User", "u"]),
                         rng.choice(["Hi.", "Yes!", "no", " ", "", None, f"t{rng.randrange(5)}?", "x ", f"q{rng.randrange(9)} \n"])))
    rows += [(1000, 1, "user", "a."), (1000, 1, "user", "a."), (1001, None, None, None)]
    return rows


NAMES = "conv_id long, turn long, role string, text string, key string, audit string, h string, kind string"


def table(spark, rows):
    return spark.createDataFrame([(*r, "k", "a", "h", "z") for r in rows], NAMES)


def brute_all(rows, ids):
    return sorted(((c, *brute_conversation([r[1:] for r in rows if r[0] == c])) for c in set(ids)), key=repr)


@pytest.mark.parametrize("segment,rules", [(256, 96), (3, 96), (2, 0), (7, 4)])
def test_conversations_are_repaired_at_least_cost(spark, segment, rules):
    rows = chats()
    got = cr.repair_conversations(cr.turns(table(spark, rows)), segment=segment, rules=rules)
    assert rows_of(got) == brute_all(rows, [r[0] for r in rows])


def test_damaged_conversations(spark):
    rows = chats(9, 90) + [(2000 + k, 0, "user", "One.") for k in range(60)]  # some lose all rows
    base = table(spark, rows)
    got = rows_of(cr.repair_conversations(damaged(cr.turns(base)), base.select("conv_id")))
    assert got == brute_all(brute_damage(rows), [r[0] for r in rows])
    assert any(r[7] == "" for r in got)


def test_repaired_turns(spark):
    rows = chats(4, 40)
    got = {}
    for r in cr.repaired_turns(cr.turns(table(spark, rows)), segment=4).orderBy("pos").collect():
        got.setdefault(r.conv_id, []).append(r)
    for c, moves in got.items():
        want = brute_conversation([r[1:] for r in rows if r[0] == c])
        assert "".join(m.edit for m in moves) == want[6]
        text = "\n".join(f"{m.role}:{m.text}" for m in moves if m.edit != "D")
        assert hashlib.sha256(text.encode()).hexdigest() == want[7]
        assert re.fullmatch("(s?(ua)+)?", "".join(m.role[0] for m in moves if m.edit != "D"))


def test_no_conversations(spark):
    nothing = table(spark, [])
    assert cr.repair_conversations(cr.turns(nothing)).count() == 0
    ids = spark.createDataFrame([(5,), (5,), (None,)], "conv_id long")
    zero = (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert rows_of(cr.repair_conversations(cr.turns(nothing), ids)) == sorted([(5, *zero), (None, *zero)], key=repr)


def test_a_conversation_of_very_many_rows(spark):
    """One conversation with 40,000 rows without a turn number, half of them one row repeated."""
    rows = [(1, None, ("user", "assistant", "tool")[k % 3], f"Text {k}{'.' if k % 5 else ''}") for k in range(20_000)]
    rows += [(1, None, "user", "Text 0.")] * 20_000 + [(2, 0, "user", "Hi."), (2, 1, "assistant", "Ho.")]
    got = {r.conv_id: r for r in cr.repair_conversations(cr.turns(table(spark, rows).repartition(6))).collect()}
    assert (got[2].audit, got[2].cost) == ("KK", 0)
    assert got[1].duplicate == 19_999
    assert len(got[1].audit.replace("I", "")) == 40_000
    assert tuple(got[1])[1:] == brute_conversation([r[1:] for r in rows if r[0] == 1])


def test_ropes_and_chains_agree_with_strings():
    rng = random.Random(3)
    for _ in range(300):
        seq = "".join(rng.choice(cr.TERMINALS) for _ in range(rng.randrange(1, 12)))
        whole = cr.Chain()
        known = cr.matrices([])
        m = cr.multiplied(seq, [], known)
        whole.add([x and x[0] for x in m], [x and cr.flat(x[1]) for x in m])
        parts = cr.Chain()
        rules = ["ua", chr(cr.RULE_SYMBOLS) + "u", "XX"]
        for k in range(0, len(seq), 3):
            m = cr.multiplied(seq[k : k + 3], rules, cr.matrices(rules))
            parts.add([x and x[0] for x in m], [x and cr.flat(x[1]) for x in m])
        fault = {"B": "blank", "X": "duplicate"}
        want = brute_audit([s.lower() if s not in "BX" else "u" for s in seq],
                           [fault.get(s, "truncated" if s.isupper() else "none") for s in seq])
        assert whole.end() == parts.end() == want


def test_grammar_replaces_frequent_pairs(spark):
    counted = spark.createDataFrame([("uauaua", 50), ("suaua", 20), ("XXXX", 1), ("u", 9)], "seq string, n long")
    rules = cr.grammar(counted, 10, 0.0)
    assert rules[0] == "ua" and len(rules) <= 10
    assert len(cr.compress("uauaua", rules)) < 3


# ---------------------------------------------------------------- hard negatives


def brute_negatives(rows, is_anchor, scale=256.0, positives=5, negatives=3):
    import math

    used = []
    for n, (i, v, label) in enumerate(rows):
        if label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            used.append((n, i, [math.floor(x * scale) for x in v], label))
    least = lambda i: (i is None, i or 0)
    out = []
    for n, i, v, label in used:
        if not is_anchor(i):
            continue
        scored = sorted(((-sum(a * b for a, b in zip(v, w, strict=False)), least(j), j, k) for m, j, w, k in used if m != n))
        for s, _, j, k in [x for x in scored if x[3] == label][:positives]:
            fits = [x for x in scored if x[3] != label and 50 * -s <= 100 * -x[0] <= 95 * -s][:negatives]
            out += [(i, j, r + 1, x[2], -s, -x[0]) for r, x in enumerate(fits)]
    return sorted(out, key=repr)


FOUND = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


def vectors(seed=6, n=260, dim=24, scale=0.4):
    rng = random.Random(seed)
    import numpy as np

    single = lambda x: float(np.float32(x))
    rows = [(k, [single(rng.gauss(0.05, scale)) for _ in range(dim)], rng.choice([0, 0, 0, 1, 2, None])) for k in range(n)]
    rows += [(None, rows[3][1], 0), (None, rows[4][1], 1), (50, rows[50][1], 1), (50, rows[50][1], 1), (500, [], 0), (550, None, 0), (600, [None] * dim, 1),
             (650, [float("nan")] + [0.0] * (dim - 1), 1), (700, [float("inf")] * dim, 2), (750, rows[9][1][:7], 0), (-50, rows[8][1], 2), (800, [0.0] * dim, 0)]
    return rows


def embeddings(spark, rows):
    return spark.createDataFrame([(*r, "x", 1) for r in rows], "vec_id long, embedding array<float>, label int, row string, q int")


def anchor(i):
    return i is not None and i % 10 == 0


@pytest.mark.parametrize("block_bytes", [hn.BLOCK_BYTES, 8 * 24 * 20])
def test_hard_negatives(spark, block_bytes):
    rows = vectors()
    got = hn.mine_hard_negatives(embeddings(spark, rows).repartition(4), F.col("vec_id") % 10 == 0, block_bytes=block_bytes).select(*FOUND)
    want = brute_negatives(rows, anchor)
    assert rows_of(got) == want and len(want) > 100


def test_hard_negatives_with_large_and_tied_values(spark):
    rng = random.Random(8)
    big = [(k, [float(rng.randrange(-(1 << 20), 1 << 20)) for _ in range(5)], k % 2) for k in range(60)]
    got = hn.mine_hard_negatives(embeddings(spark, big), F.col("vec_id") % 10 == 0).select(*FOUND)
    assert rows_of(got) == brute_negatives(big, anchor)
    tied = [(k, [1.0, 2.0], k % 2) for k in range(80)] + [(k, [0.9, 1.9], 1 - k % 2) for k in range(100, 160)]
    got = hn.mine_hard_negatives(embeddings(spark, tied), F.col("vec_id") % 10 == 0).select(*FOUND)
    assert rows_of(got) == brute_negatives(tied, anchor)
    with pytest.raises(ValueError, match="do not fit"):
        hn.mine_hard_negatives(embeddings(spark, [(0, [1e30], 1), (1, [1e30], 1)]), F.col("vec_id") % 10 == 0)


def test_hard_negatives_of_nothing(spark):
    rows = vectors(n=60)
    assert hn.mine_hard_negatives(embeddings(spark, []), F.col("vec_id") % 10 == 0).count() == 0
    assert hn.mine_hard_negatives(embeddings(spark, rows), F.col("vec_id") == 10_000).count() == 0
    assert hn.mine_hard_negatives(embeddings(spark, [(0, [1.0], 1)]), F.col("vec_id") % 10 == 0).count() == 0


def test_residue_products_are_exact():
    import numpy as np

    rng = np.random.default_rng(1)
    for dim, size in ((1, 10**9), (64, 200), (200, 10**7), (1000, 3)):
        a, b = (rng.integers(-size, size + 1, (n, dim)) for n in (7, 5))
        bound = max(float((x.astype(float) ** 2).sum(axis=1).max()) for x in (a, b))
        primes = hn.primes_for(bound)
        got = hn.product(hn.residues(a, primes), hn.residues(b, primes), primes)
        assert (got == np.array([[sum(int(x) * int(y) for x, y in zip(r, s, strict=True)) for s in b] for r in a])).all()
        assert len(primes) > 1 or bound < 500
