"""Conversation structure repair: grammar-compressed dynamic programming.

Each row of a conversation has a first fault (blank, duplicate, truncated or none). The
cheapest edits turn its role initials into ``(s?(ua)+)?``: Keep (0), Rerole to user or
assistant (1), Delete (2; required for blank and duplicate rows), Insert an empty user or
assistant turn anywhere (5); a truncated row that is not deleted adds 5. The audit is the
edits' initials in order; of equal costs the ASCII-least audit is taken. An insert or
rerole has one legal role in each state of the automaton (nothing yet, system, user,
assistant), so the audit fixes the repair.

Method: a conversation is a string over ten symbols (role initial or other, truncated or
not; blank; duplicate). Re-Pair replaces the most frequent adjacent pairs of all
conversations by rules. Each rule has one min-plus transfer matrix: for each entry and
exit state the least cost and the audit of it, a rope that shares the parts of the rules
below. Matrices are made bottom-up, once per rule; each different compressed segment is
multiplied out once and joined to all conversations that hold it. Two audits of equal cost
over the same rows are never prefixes of one another (what one has more is inserts, which
cost), so the order of ropes survives concatenation and the products are exact.

Scale: the light rows (no texts) are grouped, so that repeated rows are one row with a
count, and dealt by range of (conversation, turn, role, text digest), so a conversation of
any size is cut into segments of ``SEGMENT`` rows. Rules are chosen from pair counts
summed in Spark; the grammar is bounded by ``RULES``. Rules that are not made only leave
segments longer. A conversation's segments are chained as a stream: four least audits,
and for each two of them which is smaller. Texts move once, by conversation, and are
streamed through the repair: a task holds one batch and one audit, not a conversation
(its digest is one sequence by definition).

Defined cases: a null role or text is one space, so a null text is blank; rows sort by turn
(null first), then role, then text digest (md5), so ties have a fixed order; a null id is a
conversation of its own; repeated rows are duplicates of the first; a role is judged by its
first character and another initial than s, u, a must be reroled or deleted; an id without
rows has zeros, an empty audit and the digest of nothing; an empty table gives no rows;
other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .storage import store
from .streams import groups, written

SEGMENT = 256
#: rules at most, rules made a round, and the least share of all pairs that a rule replaces
RULES, ROUND_RULES, LEAST_SHARE = 96, 8, 0.001
RULE_SYMBOLS = 0x4E00  # rules are written as characters from here on

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
START, SYSTEM, USER, ASSISTANT = range(4)
STATES = range(4)
#: the state after a role's initial, where it is legal
LEGAL = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
#: the state after the one turn that may be inserted, or the one role that a turn may get
NEXT = (USER, USER, ASSISTANT, USER)
ROLE = {USER: "user", ASSISTANT: "assistant"}
#: inserts that end a conversation legally
TAIL = ("", "II", "I", "")
BLANK, DUPLICATE = "B", "X"
TERMINALS = "suaoSUAO" + BLANK + DUPLICATE

# ---------------------------------------------------------------- transfer matrices

#: a rope is a string or a pair of ropes; an entry is (cost, rope) or None; a matrix has 16 entries
Entry = tuple[int, object] | None
Matrix = list[Entry]


def flat(rope: object) -> str:
    out, todo = [], [rope]
    while todo:
        x = todo.pop()
        if isinstance(x, str):
            out.append(x)
        else:
            todo += (x[1], x[0])
    return "".join(out)


def better(a: Entry, b: Entry) -> Entry:
    """The entry of lower cost, then of the ASCII-least audit."""
    if a is None or b is None:
        return b if a is None else a
    if a[0] != b[0]:
        return a if a[0] < b[0] else b
    return a if flat(a[1]) <= flat(b[1]) else b


def times(a: Matrix, b: Matrix) -> Matrix:
    """The min-plus product; ropes are joined, not copied."""
    out: Matrix = []
    for p in STATES:
        for q in STATES:
            best: Entry = None
            for m in STATES:
                x, y = a[4 * p + m], b[4 * m + q]
                if x is not None and y is not None:
                    best = better(best, (x[0] + y[0], (x[1], y[1])))
            out.append(best)
    return out


def _matrix(moves: dict[tuple[int, int], Entry]) -> Matrix:
    return [moves.get((p, q)) for p in STATES for q in STATES]


def _inserts() -> Matrix:
    """No insert, one or two (more come back to a state that fewer reach)."""
    one = _matrix({(p, NEXT[p]): (INSERT, "I") for p in STATES})
    none = _matrix({(p, p): (0, "") for p in STATES})
    return [better(better(x, y), z) for x, y, z in zip(none, one, times(one, one), strict=True)]


def terminal(symbol: str) -> Matrix:
    """Inserts, then the row itself."""
    row: dict[tuple[int, int], Entry] = {(p, p): (DELETE, "D") for p in STATES}
    if symbol not in (BLANK, DUPLICATE):
        more = TRUNCATED if symbol.isupper() else 0
        for p in STATES:
            row[p, NEXT[p]] = better(row.get((p, NEXT[p])), (REROLE + more, "R"))
            q = LEGAL.get((p, symbol.lower()))
            if q is not None:
                row[p, q] = better(row.get((p, q)), (KEEP + more, "K"))
    return times(_inserts(), _matrix(row))


def matrices(rules: list[str]) -> dict[str, Matrix]:
    """The matrix of every symbol; rule k stands for its two symbols, made before it."""
    out = {s: terminal(s) for s in TERMINALS}
    for k, pair in enumerate(rules):
        out[chr(RULE_SYMBOLS + k)] = times(out[pair[0]], out[pair[1]])
    return out


def compress(seq: str, rules: list[str]) -> str:
    for k, pair in enumerate(rules):
        seq = seq.replace(pair, chr(RULE_SYMBOLS + k))
    return seq


def multiplied(seq: str, rules: list[str], known: dict[str, Matrix]) -> Matrix:
    symbols = compress(seq, rules)
    total = known[symbols[0]]
    for s in symbols[1:]:
        total = times(total, known[s])
    return total


# ---------------------------------------------------------------- chaining segments


class Chain:
    """The least audit into each state, over segments in order.

    An audit is a linked list of pieces. ``rel[p, q]`` says how the audits of two states
    compare: -1 or 1, or ("I", j): that of q is that of p and j inserts more (j may be negative).
    """

    def __init__(self) -> None:
        self.at: list[Entry] = [(0, None), None, None, None]
        self.rel: dict[tuple[int, int], object] = {}

    def _compare(self, p: int, y: str, q: int, z: str) -> object:
        known = ("I", 0) if p == q else self.rel[p, q] if p < q else self._turned(self.rel[q, p])
        if not isinstance(known, tuple):
            return known
        j = known[1]
        y, z = "I" * max(-j, 0) + y, "I" * max(j, 0) + z
        if z.startswith(y) or y.startswith(z):
            return ("I", len(z) - len(y))
        return -1 if y < z else 1

    @staticmethod
    def _turned(known: object) -> object:
        return ("I", -known[1]) if isinstance(known, tuple) else -known

    def _first(self, options: list[tuple[int, int, str]]) -> tuple[int, int, str]:
        """Of (cost, state before, piece) the cheapest, then the ASCII-least."""
        best = options[0]
        for x in options[1:]:
            if x[0] < best[0]:
                best = x
            elif x[0] == best[0]:
                order = self._compare(x[1], x[2], best[1], best[2])
                if order == -1 or (isinstance(order, tuple) and order[1] > 0):
                    best = x
        return best

    def add(self, costs: list[int | None], audits: list[str | None]) -> None:
        chosen: list[tuple[int, int, str] | None] = []
        for q in STATES:
            options = [(self.at[p][0] + costs[4 * p + q], p, audits[4 * p + q])
                       for p in STATES if self.at[p] is not None and costs[4 * p + q] is not None]
            chosen.append(self._first(options) if options else None)
        rel = {}
        for p in STATES:
            for q in range(p + 1, 4):
                x, y = chosen[p], chosen[q]
                if x is not None and y is not None:
                    rel[p, q] = self._compare(x[1], x[2], y[1], y[2])
        self.at = [None if x is None else (x[0], (self.at[x[1]][1], x[2])) for x in chosen]
        self.rel = rel

    def end(self) -> tuple[int, str]:
        cost, state, tail = self._first([(self.at[p][0] + INSERT * len(TAIL[p]), p, TAIL[p]) for p in STATES if self.at[p] is not None])
        pieces, node = [tail], self.at[state][1]
        while node is not None:
            node, piece = node
            pieces.append(piece)
        return cost, "".join(reversed(pieces))


# ---------------------------------------------------------------- in Spark

_SPACE = r"\x20\x09-\x0D"


def _one_space(c: str) -> Column:
    return F.coalesce(F.col(c), F.lit(" "))


def turns(chats: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """conv_id, turn, role, text, h: the rows with nulls as one space and a digest to order ties by."""
    rows = chats.select(F.col(conv_id).alias("conv_id"), F.col(turn).cast("long").alias("turn"), _one_space(role).alias("role"), _one_space(text).alias("text"))
    return rows.withColumn("h", F.md5("text"))


ORDER = [F.asc_nulls_first, F.asc_nulls_first, F.asc, F.asc]
ORDER_BY = ["conv_id", "turn", "role", "h"]


def _in_order() -> list[Column]:
    return [by(c) for by, c in zip(ORDER, ORDER_BY, strict=True)]


def faults(rows: DataFrame) -> DataFrame:
    """One row per (conversation, turn, role, text): copies, fresh (the first copy is no duplicate), blank, cut."""
    light = rows.select(
        "conv_id", "turn", "role", "h", (~F.col("text").rlike(f"[^{_SPACE}]")).alias("blank"),
        (~F.col("text").rlike(rf"[.!?][{_SPACE}]*\z")).alias("cut"))
    groups = light.groupBy("conv_id", "turn", "role", "h", "blank", "cut").agg(F.count(F.lit(1)).alias("copies"))
    same = F.struct("conv_id", "role", "h")  # nulls in a struct are equal in a join
    place = F.struct(F.col("turn").isNotNull().alias("known"), "turn")
    first = groups.groupBy(same.alias("same")).agg(F.min(place).alias("first"))
    return groups.withColumn("same", same).join(first, "same").select(
        "conv_id", "turn", "role", "h", "copies", "blank", "cut", place.eqNullSafe(F.col("first")).alias("fresh"))


def _symbol() -> Column:
    initial = F.substring("role", 1, 1)
    known = F.when(initial.isin("s", "u", "a"), initial).otherwise(F.lit("o"))
    return F.when(F.col("blank"), F.lit(BLANK)).when(~F.col("fresh"), F.lit(DUPLICATE)).when(F.col("cut"), F.upper(known)).otherwise(known)


def segments(faulty: DataFrame, segment: int = SEGMENT) -> DataFrame:
    """key (a struct with conv_id), part, k, seq: the symbols of each conversation in order, ``segment`` a row; stored."""
    light = faulty.select("conv_id", "turn", "role", "h", _symbol().alias("symbol"), F.col("blank"), "copies")
    ordered = light.repartitionByRange(*_in_order()).sortWithinPartitions(*_in_order()).select(
        F.struct("conv_id").alias("key"), F.spark_partition_id().alias("part"), "symbol", "blank", "copies")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        k = 0
        for (key,), rows in groups(batches, ["key"]):
            held = ""
            for r in rows:
                left, again = r["copies"] - 1, BLANK if r["blank"] else DUPLICATE
                held += r["symbol"]
                while left or len(held) >= segment:
                    more = min(left, segment - min(len(held), segment))
                    held, left = held + again * more, left - more
                    if len(held) >= segment:
                        yield key, r["part"], k, held
                        held, k = "", k + 1
                part = r["part"]
            if held:
                yield key, part, k, held
                k += 1

    key_type = pa.struct([("conv_id", _arrow_type(faulty, "conv_id"))])
    schema = pa.schema([("key", key_type), ("part", pa.int32()), ("k", pa.int64()), ("seq", pa.string())])
    kind = faulty.schema["conv_id"].dataType.simpleString()
    return store(ordered.mapInArrow(lambda b: written(cut(b), schema), f"key struct<conv_id:{kind}>, part int, k long, seq string"), "segments")


def _arrow_type(df: DataFrame, column: str) -> pa.DataType:
    return {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}[df.schema[column].dataType.simpleString()]


def grammar(counted: DataFrame, most: int = RULES, least_share: float = LEAST_SHARE) -> list[str]:
    """Re-Pair rules over (seq, n): the most frequent pairs first, several a round if they share no symbol."""
    rules: list[str] = []
    while len(rules) < most:
        made = list(rules)

        def count(batches: Iterator[pa.RecordBatch], made: list[str] = made) -> Iterator[pa.RecordBatch]:
            pairs: Counter[str] = Counter()
            for b in batches:
                for seq, n in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                    s = compress(seq, made)
                    for k in range(len(s) - 1):
                        pairs[s[k : k + 2]] += n
            if pairs:
                yield pa.RecordBatch.from_arrays([pa.array(list(pairs)), pa.array(list(pairs.values()), pa.int64())], ["pair", "n"])

        # at most (symbols)^2 pairs; their number does not follow the input
        found = counted.select("seq", "n").mapInArrow(count, "pair string, n long").groupBy("pair").agg(F.sum("n").alias("n")).collect()
        total = sum(r.n for r in found)
        used: set[str] = set()
        for r in sorted(found, key=lambda r: (-r.n, r.pair))[: 4 * ROUND_RULES]:
            if r.n < max(2, least_share * total) or len(rules) == most or len(rules) - len(made) == ROUND_RULES:
                break
            if not used & set(r.pair):
                rules.append(r.pair)
                used |= set(r.pair)
        if len(rules) == len(made):
            break
    return rules


def audits(faulty: DataFrame, segment: int = SEGMENT, rules: int = RULES) -> DataFrame:
    """key, cost, audit: the cheapest repair of each conversation that has rows."""
    cut = segments(faulty, segment)
    counted = store(cut.groupBy("seq").agg(F.count(F.lit(1)).alias("n")), "sequences")
    made = grammar(counted, rules)

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        known = matrices(made)
        for b in batches:
            for seq in b.column(0).to_pylist():
                m = multiplied(seq, made, known)
                yield seq, [None if x is None else x[0] for x in m], [None if x is None else flat(x[1]) for x in m]

    schema = pa.schema([("seq", pa.string()), ("costs", pa.list_(pa.int64())), ("audits", pa.list_(pa.string()))])
    shared = store(counted.select("seq").mapInArrow(lambda b: written(multiply(b), schema), "seq string, costs array<long>, audits array<string>"), "matrices")

    def chain(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for (key,), rows in groups(batches, ["key"]):
            c = Chain()
            for r in rows:
                c.add(r["costs"], r["audits"])
            yield key, *c.end()

    key_type = pa.struct([("conv_id", _arrow_type(faulty, "conv_id"))])
    out = pa.schema([("key", key_type), ("cost", pa.int64()), ("audit", pa.string())])
    kind = faulty.schema["conv_id"].dataType.simpleString()
    met = cut.join(shared, "seq").select("key", "part", "k", "costs", "audits")
    return met.repartition("key").sortWithinPartitions("key", "part", "k").mapInArrow(
        lambda b: written(chain(b), out), f"key struct<conv_id:{kind}>, cost long, audit string")


def edited(audit: str, rows: Iterator[tuple[str, str]]) -> Iterator[tuple[str, str | None, str]]:
    """(edit, role, text) of each edit in order; a deleted row has no role."""
    state, letters = START, iter(audit)

    def inserts() -> Iterator[tuple[str, str, str]]:
        nonlocal state, edit
        while edit == "I":
            state = NEXT[state]
            yield "I", ROLE[state], ""
            edit = next(letters, None)

    edit = next(letters, None)
    for role, text in rows:
        yield from inserts()
        if edit == "K":
            state = LEGAL[state, role[:1]]
            yield "K", role, text
        elif edit == "R":
            state = NEXT[state]
            yield "R", ROLE[state], text
        else:
            yield "D", None, text
        edit = next(letters, None)
    yield from inserts()


def _together(rows: DataFrame, ids: DataFrame, segment: int, rules: int) -> DataFrame:
    """Each conversation's audit, followed by its rows: sorted within partitions by conversation."""
    faulty = store(faults(rows), "faults")
    one = F.when(~F.col("blank") & F.col("fresh"), 1).otherwise(0)
    counts = faulty.groupBy(F.struct("conv_id").alias("key")).agg(
        F.sum(F.when(F.col("blank"), F.col("copies")).otherwise(0)).alias("blank"),
        F.sum(F.when(F.col("blank"), 0).otherwise(F.col("copies") - one)).alias("duplicate"),
        F.sum(F.when(F.col("cut"), one).otherwise(0)).alias("truncated"))
    heads = ids.select(F.struct("conv_id").alias("key")).distinct().join(counts, "key", "left").join(audits(faulty, segment, rules), "key", "left")
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    heads = heads.select("key.conv_id", F.lit(0).alias("kind"), zero("blank"), zero("duplicate"), zero("truncated"), zero("cost"),
                         F.coalesce("audit", F.lit("")).alias("audit"))
    body = rows.select("conv_id", F.lit(1).alias("kind"), "turn", "role", "h", "text")
    both = heads.unionByName(body, allowMissingColumns=True)
    return both.repartition("conv_id").sortWithinPartitions(F.asc_nulls_first("conv_id"), "kind", *_in_order()[1:])


_RESULT = [("gaps", pa.int64()), ("blank", pa.int64()), ("duplicate", pa.int64()), ("truncated", pa.int64()), ("illegal", pa.int64()),
           ("cost", pa.int64()), ("audit", pa.string()), ("repaired_sha256", pa.string())]


def repair_conversations(rows: DataFrame, ids: DataFrame | None = None, segment: int = SEGMENT, rules: int = RULES) -> DataFrame:
    """One row per conversation of :func:`turns`: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit,
    repaired_sha256 (of the repaired ``role:text`` lines). ``ids`` (conv_id) may name conversations without rows."""
    ids = rows.select("conv_id") if ids is None else ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for (conv,), stream in groups(batches, ["conv_id"]):
            head = next(stream)
            seen = _Seen()
            digest, lead = hashlib.sha256(), b""
            for edit, role, text in edited(head["audit"], seen.over(stream)):
                if edit != "D":
                    digest.update(lead + f"{role}:{text}".encode())
                    lead = b"\n"
            yield (conv, seen.gaps(), head["blank"], head["duplicate"], head["truncated"], seen.illegal, head["cost"], head["audit"], digest.hexdigest())

    schema = pa.schema([("conv_id", _arrow_type(rows, "conv_id")), *_RESULT])
    kind = rows.schema["conv_id"].dataType.simpleString()
    types = {pa.int64(): "long", pa.string(): "string"}
    ddl = f"conv_id {kind}, " + ", ".join(f"{n} {types[t]}" for n, t in _RESULT)
    return _together(rows, ids, segment, rules).mapInArrow(lambda b: written(run(b), schema), ddl)


def repaired_turns(rows: DataFrame, segment: int = SEGMENT, rules: int = RULES) -> DataFrame:
    """conv_id, pos, edit, role, text: every edit of every conversation in order (a deleted row has no role)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for (conv,), stream in groups(batches, ["conv_id"]):
            head = next(stream)
            for pos, move in enumerate(edited(head["audit"], ((r["role"], r["text"]) for r in stream))):
                yield conv, pos, *move

    schema = pa.schema([("conv_id", _arrow_type(rows, "conv_id")), ("pos", pa.int64()), ("edit", pa.string()), ("role", pa.string()), ("text", pa.string())])
    kind = rows.schema["conv_id"].dataType.simpleString()
    return _together(rows, rows.select("conv_id"), segment, rules).mapInArrow(
        lambda b: written(run(b), schema), f"conv_id {kind}, pos long, edit string, role string, text string")


class _Seen:
    """What the stream of a conversation's rows tells about its order."""

    def __init__(self) -> None:
        self.illegal, self.distinct = 0, 0
        self.least: int | None = None
        self.most: int | None = None
        self.initial: str | None = None

    def over(self, rows: Iterator[dict]) -> Iterator[tuple[str, str]]:
        for r in rows:
            if r["turn"] is not None:
                self.distinct += r["turn"] != self.most
                self.least = r["turn"] if self.least is None else self.least
                self.most = r["turn"]
            if self.initial is not None and self.initial + r["role"][:1] not in ("su", "ua", "au"):
                self.illegal += 1
            self.initial = r["role"][:1]
            yield r["role"], r["text"]

    def gaps(self) -> int:
        return 0 if self.most is None else self.most - self.least + 1 - self.distinct
