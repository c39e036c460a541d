"""Document fingerprints: Order MinHash over words, in DataFrame functions only.

A text is a sequence of symbols: words between white space, and single characters in
scripts that are written without spaces. Its k-mers are runs of ``K`` symbols (a shorter text is one k-mer), numbered by
occurrence: the n-th occurrence of a k-mer is an element of its own. All elements lie on
a ring of 64-bit hashes. Component j of the signature starts at the j-th of
``COMPONENTS`` evenly spaced points of the ring (each start is a permutation of its own:
the hash order, rotated), selects the ``TUPLE`` elements that follow, puts them back into
text order and hashes the tuple. Two texts agree in a component if they share these
elements and have them in the same order, so the share of equal components falls with
moved text as well as with replaced text.

The whole fingerprint is one Column expression over the text: arrays and lambdas of
Spark, no Python in the executors. Sorting is ``sort_array`` per text; nothing is
exploded or shuffled, so a document's k-mers never leave its row.

``with_next`` finds each document's next one. The rows are cut into blocks at sampled rows
of the total order (id, text hash, row number): a block starts with such a row, which is
also sent to the block before as its end mark. So texts move once, a block is a bounded
share of the rows even if they all have one id or one text, and ``lead`` within blocks
gives every row its next.

Defined cases: a null text is empty; an empty text, or one of white space, has an empty
fingerprint, which is like another empty one (1.0) and unlike any other (0.0); white space
between words does not count; null ids come last, rows of one id in order of their text
hash; a single document is its own next; repeated rows follow each other; an empty table
gives no rows; other columns are kept out of the way in structs. The documents are read
twice (once for the blocks), so they must be a scan or a written table.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from etalage.operators.ranges import MOST_RANGES, binary_search

K, TUPLE, COMPONENTS = 3, 2, 64
#: an element is one long: its hash above, its place in the text (modulo PLACE) in the low bits
BITS = 23
PLACE = (1 << BITS) - 1
#: blocks are cut at every so many sampled rows
OVERSAMPLE = 16

SPACE = " \t\n\x0b\x0c\r"
#: Thai, Lao, Burmese, Khmer, kana and Han characters stand for themselves
ALONE = "([\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u9fff\uf900-\ufaff\U00020000-\U0003ffff])"


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value worked out once, wherever it is used."""
    return F.transform(F.array(value), use)[0]


def _indices(n: Column) -> Column:
    """0 .. n - 1."""
    return F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))


def symbols(text: Column) -> Column:
    """The words of a text, and its characters of scripts without spaces."""
    wide = F.octet_length(text) - F.char_length(text) >= 2  # else all characters are of one byte, but one of two
    spaced = F.btrim(F.when(wide, F.regexp_replace(text, ALONE, " $1 ")).otherwise(text), F.lit(SPACE))
    return F.when(spaced != "", F.split(spaced, r"[\x20\x09-\x0D]+")).otherwise(F.array().cast("array<string>"))


def _packed(h: Column, place: Column) -> Column:
    """A hash and a place (from 1) in one long that sorts by the hash."""
    return h.bitwiseAND(F.lit(~PLACE)).bitwiseOR(place.cast("long"))


def _place(x: Column) -> Column:
    return x.bitwiseAND(F.lit(PLACE))


def elements(text: Column, k: int = K) -> Column:
    """The occurrence-numbered k-mers of a text, each a hash and its place packed."""

    def kmers(w: Column) -> Column:
        count = F.when(F.size(w) > 0, F.greatest(F.size(w) - (k - 1), F.lit(1))).otherwise(0)
        return F.transform(_indices(count), lambda i: _packed(F.xxhash64(*[F.get(w, i + j) for j in range(k)]), i % PLACE + 1))

    def again(s: Column, i: Column, x: Column) -> Column:
        """Whether the k-mer before is the same."""
        return (i > 0) & (F.shiftright(F.get(s, i - 1).bitwiseXOR(x), BITS) == 0)

    def element(x: Column, n: Column) -> Column:
        return _packed(F.xxhash64(F.shiftright(x, BITS), n), _place(x))

    def repeats(r: Column) -> Column:
        """Second and later occurrences, those of a k-mer together: numbered from where they start."""
        starts = F.filter(_indices(F.size(r)), lambda i: ~again(r, i, F.get(r, i)))
        return let(starts, lambda at: F.flatten(F.transform(at, lambda start, j: F.transform(
            F.slice(r, start + 1, F.coalesce(F.get(at, j + 1), F.size(r)) - start), lambda x, n: element(x, n + 1)))))

    def numbered(s: Column) -> Column:
        first = F.transform(F.filter(s, lambda x, i: ~again(s, i, x)), lambda x: element(x, F.lit(0)))
        return F.concat(first, let(F.filter(s, lambda x, i: again(s, i, x)), lambda r: F.when(F.size(r) > 0, repeats(r)).otherwise(r)))

    return let(symbols(text), lambda w: let(F.sort_array(kmers(w)), numbered))


def fingerprint(text: Column, k: int = K, length: int = TUPLE, components: int = COMPONENTS) -> Column:
    """The signature: an array of ``components`` ints, empty for a text without symbols."""
    step = (1 << 64) // components
    marks = F.array(*[F.lit(j * step - (1 << 63)).cast("long") for j in range(components)])  # place 0

    def chosen(ring: Column, at: Column, n: Column) -> Column:
        """``length`` elements from ``at`` on, in text order."""
        return F.sort_array(F.transform(F.sequence(F.lit(0), F.least(F.lit(length), n) - 1), lambda t: let(
            F.get(ring, (at + t) % n), lambda x: F.shiftleft(_place(x), 63 - BITS).bitwiseOR(F.shiftrightunsigned(x, BITS + 1)))))

    def select(ring: Column, found: Column) -> Column:
        """The tuple hash after each mark; a mark's place in the ring less the marks before it is where its elements begin."""
        return F.transform(found, lambda place, j: F.shiftright(F.xxhash64(F.transform(
            chosen(ring, place - j, F.size(ring)), lambda x: x.bitwiseAND(F.lit((1 << (63 - BITS)) - 1)))), 32).cast("int"))

    def signed(e: Column) -> Column:
        return let(F.sort_array(F.concat(e, marks)), lambda merged: let(F.filter(merged, lambda x: _place(x) != 0), lambda ring: select(
            ring, F.filter(_indices(F.size(merged)), lambda i: _place(F.get(merged, i)) == 0))))

    return let(elements(text, k), lambda e: F.when(F.size(e) > 0, signed(e)).otherwise(F.array().cast("array<int>")))


def as_text(signature: Column) -> Column:
    """Eight hexadecimal digits a component."""
    return F.array_join(F.transform(signature, lambda x: F.lower(F.lpad(F.hex(x.cast("long").bitwiseAND(F.lit(0xFFFFFFFF))), 8, "0"))), "")


def likeness(a: Column, b: Column) -> Column:
    """The share of equal components."""
    equal = F.aggregate(F.zip_with(a, b, lambda x, y: F.when(x == y, 1).otherwise(0)), F.lit(0), lambda total, x: total + x)
    return F.when((F.size(a) == 0) | (F.size(b) == 0), (F.size(a) == F.size(b)).cast("double")).otherwise(equal / F.size(a))


_KEY = {"last": "boolean", "at": "bigint", "tie": "bigint", "row": "bigint"}


def with_next(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", extra: Callable[[Column], Column] | None = None,
              blocks: int | None = None) -> DataFrame:
    """own (doc_id, text, extra) and next (text, extra) of every row, in order of the ids; the last row's next is the first.

    ``extra`` is a Column of the text that is worked out before the rows move.
    """
    spark = docs.sparkSession
    blocks = min(MOST_RANGES, blocks or 4 * int(spark.conf.get("spark.sql.shuffle.partitions", "200")))
    base = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"),
                       F.monotonically_increasing_id().alias("row"))
    parts = (F.col("doc_id").isNull(), F.coalesce("doc_id", F.lit(0).cast("long")), F.xxhash64("text"), F.col("row"))
    # a part without an ELSE counts as nullable, as those of the parsed bounds do, so no cast is planned
    key = F.struct(*[F.when(v.isNotNull(), v).alias(c) for c, v in zip(_KEY, parts, strict=True)])
    n = base.count()
    if not n:
        empty = F.struct("text", (extra(F.col("text")) if extra else F.lit(None)).alias("extra"))
        return base.select(F.struct("doc_id", empty["text"].alias("text"), empty["extra"].alias("extra")).alias("own"), empty.alias("next"))
    # blocks * OVERSAMPLE keys come to the driver, whatever the table's size; they decide balance, not results
    one_of = max(1, n // (blocks * OVERSAMPLE))
    sample = sorted(tuple(r.key) for r in base.where(F.pmod(F.xxhash64("row"), F.lit(one_of)) == 0).select(key.alias("key")).collect())
    first = tuple(base.agg(F.min(key).alias("key")).first().key)
    cuts = sorted({first, *sample[:: max(1, len(sample) // blocks)]})
    kind = f"array<struct<{','.join(f'{c}:{t}' for c, t in _KEY.items())}>>"
    bounds = F.from_json(F.lit(json.dumps([dict(zip(_KEY, k, strict=True)) for k in cuts])), kind)  # one literal, sorted
    value = extra(F.col("text")) if extra else F.lit(None)
    rows = base.select(key.alias("key"), "text", value.alias("extra"))
    rows = rows.withColumn("block", binary_search(bounds, len(cuts), F.col("key")) - 1)
    starts = F.get(bounds, F.col("block")) == F.col("key")
    before = F.pmod(F.col("block") - 1, F.lit(len(cuts)))
    sent = F.when(starts, F.array(F.struct(F.col("block").alias("block"), F.lit(False).alias("mark")), F.struct(before.alias("block"), F.lit(True).alias("mark"))))
    dealt = rows.withColumn("to", F.explode(sent.otherwise(F.array(F.struct(F.col("block"), F.lit(False).alias("mark"))))))
    follow = Window.partitionBy("block").orderBy("mark", "key")
    after = {c: F.lead(c, 1).over(follow) for c in ("text", "extra")}
    return dealt.select("key", "text", "extra", "to.block", "to.mark").withColumns({f"next_{c}": v for c, v in after.items()}).where(
        ~F.col("mark")).select(
            F.struct(F.when(~F.col("key.last"), F.col("key.at")).alias("doc_id"), "text", "extra").alias("own"),
            F.struct(F.col("next_text").alias("text"), F.col("next_extra").alias("extra")).alias("next"))


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_chars, edited (the text with its last half from the next document), fingerprint, edited_fingerprint,
    near_edited, near_next."""
    rows = with_next(docs, doc_id, text, fingerprint)
    n = F.char_length("own.text")
    half = F.floor(n / 2).cast("int")
    rows = rows.select("own.doc_id", n.cast("long").alias("n_chars"), F.col("own.extra").alias("signature"), F.col("next.extra").alias("next_signature"),
                       F.concat(F.substring("own.text", F.lit(1), n - half), F.substring("next.text", F.lit(1), half)).alias("edited"))
    rows = rows.withColumn("edited_signature", fingerprint(F.col("edited")))
    own, edited = F.col("signature"), F.col("edited_signature")
    return rows.select("doc_id", "n_chars", "edited", as_text(own).alias("fingerprint"), as_text(edited).alias("edited_fingerprint"),
                       likeness(own, edited).alias("near_edited"), likeness(own, F.col("next_signature")).alias("near_next"))
