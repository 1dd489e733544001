"""Line dedup by a fixed-depth tree of log templates.

DataFrame functions only. A line's tokens with digits become ``<*>``. The tree's
first level is the token count, the next is the leading stretch of the line, then
come its other stretches, ``STRETCHES`` in all; below each node there is a child for
each stretch of tokens and one that takes any. A line lies at the end of all paths
that take any stretch at most ``FREE`` times, so templates generalise fields of
words wherever they stand, the lead included. A path is a template if at least
``LEAST_FIXED`` of its tokens and half of the line's (rounded down) are fixed: that
is how similar its lines are. Masked tokens are not fixed ones. Paths whose lines
all lie at another one, too, are left out.

Templates that at least ``min_docs`` documents hold are dropped from all but the
first of them; so are whole masked lines, with nothing free, from ``WHOLE_DOCS``
documents on. A line all of whose tokens have digits stands for itself only.

Lines travel as hashes. First the hash of each template is counted by documents;
what recurs is written as bits into words of a table of bounded size, which goes to
all tasks. Only the templates that fit a bit are exchanged again, with a second
hash, to be counted for sure and to find the first document, so the size of the
table decides how much is exchanged and nothing else. Rows for a template are
counted before they are exchanged, so one that a third of all documents share costs
a row for each task.

Defined cases: a null text has no lines and stays null; lines without tokens
stay; equal lines within one document count once; rows of equal id and text are one
document, and rows of equal id count once for a template, those without one by
their texts; documents with the smallest id keep their lines; with null ids only, none is first and recurring
lines go from all; further columns are ignored; an empty table gives an empty
result. All work is in proportion to the number of lines, however many one text has.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..storage import keep, materialize

UNEVEN = r"[\t\x0B\f\r]|\x20\x20"  # what isn't a single space between tokens
MASK = "<*>"
#: A token with a digit: begun where a token begins, without steps back, so that long tokens cost no more than their length.
VARIABLE = r"(?<![^\x20\x09-\x0D])[^\x20\x09-\x0D0-9]*+[0-9][^\x20\x09-\x0D]*+"
STRETCHES = 4  # levels of the tree below the token count; the first is the lead
FREE = 2  # stretches that a template leaves free at most
LEAST_FIXED = 4  # tokens that it holds fast at least, and half of all
MIN_DOCS = 3
WHOLE_DOCS = 2  # for lines with nothing free
WORDS = 1 << 20  # of 64 bits each, at most, in the table of what recurs
BITS_EACH = 16  # bits for each template that recurs, where there is room

#: Stretches that can be free together.
PATHS = [free for n in range(1, FREE + 1) for free in combinations(range(STRETCHES), n)]


def _once(value: Column, then) -> Column:  # noqa: ANN001
    """then(value), with the value made once."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


def _masked_tokens(piece: Column) -> Column:
    """How often the mask stands in a stretch."""
    return F.when(F.contains(piece, F.lit(MASK)), (F.length(piece) - F.length(F.replace(piece, F.lit(MASK), F.lit("")))) / len(MASK)).otherwise(0).cast("int")


def _line(line: Column) -> Column:
    """(n, paths, s0.., whole): token count, bits of the templates among PATHS, hashes of the stretches and of the whole line; null without tokens."""
    masked = F.when(line.rlike("[0-9]"), F.regexp_replace(line, VARIABLE, MASK)).otherwise(line)

    def counted(t: Column) -> Column:
        return F.when(t != "", _once(F.struct(t.alias("l"), (F.length(t) - F.length(F.replace(t, F.lit(" "), F.lit(""))) + 1).alias("n")), cut))

    def cut(x: Column) -> Column:
        upto = lambda j: F.when(F.floor(x["n"] * j / STRETCHES) > 0, F.call_function("substring_index", x["l"], F.lit(" "), F.floor(x["n"] * j / STRETCHES).cast("int"))).otherwise("")
        heads = F.struct(x["n"].alias("n"), *(upto(j).cast("binary").alias(f"h{j}") for j in range(1, STRETCHES)), x["l"].cast("binary").alias(f"h{STRETCHES}"))
        return _once(heads, parts)

    def parts(h: Column) -> Column:
        # as bytes, which are cut without counting characters
        def piece(j: int) -> Column:
            if j == 0:
                return h["h1"]
            ahead = F.octet_length(h[f"h{j}"])
            return F.when(ahead == 0, h[f"h{j + 1}"]).otherwise(F.substring(h[f"h{j + 1}"], ahead + 2, F.octet_length(h[f"h{j + 1}"])))

        return _once(F.struct(h["n"].alias("n"), *(piece(j).cast("string").alias(f"p{j}") for j in range(STRETCHES))), fixed)

    def fixed(p: Column) -> Column:
        size = lambda j: (F.floor(p["n"] * (j + 1) / STRETCHES) - F.floor(p["n"] * j / STRETCHES)).cast("int")
        return _once(F.struct(*(F.xxhash64(p[f"p{j}"]).alias(f"s{j}") for j in range(STRETCHES)), p["n"].cast("int").alias("n"), *((size(j) - _masked_tokens(p[f"p{j}"])).alias(f"f{j}") for j in range(STRETCHES))), told)

    def told(x: Column) -> Column:
        def allowed(free: tuple[int, ...]) -> Column:
            held = sum((x[f"f{j}"] for j in range(STRETCHES) if j not in free), F.lit(0))
            return (held >= LEAST_FIXED) & (held >= F.floor(x["n"] / 2))

        def wanted(free: tuple[int, ...]) -> Column:
            wider = F.lit(False)
            for other in PATHS:
                if len(other) > len(free) and set(free) < set(other):
                    wider = wider | allowed(other)
            return allowed(free) & ~wider

        paths = sum((F.when(wanted(free), 1 << k).otherwise(0) for k, free in enumerate(PATHS)), F.lit(0))
        stretches = [x[f"s{j}"] for j in range(STRETCHES)]
        bare = sum((x[f"f{j}"] for j in range(STRETCHES)), F.lit(0)) == 0
        whole = F.when(bare, F.xxhash64(F.trim(line), x["n"])).otherwise(F.xxhash64(*stretches, x["n"]))
        return F.struct(x["n"].alias("n"), paths.alias("paths"), *(s.alias(f"s{j}") for j, s in enumerate(stretches)), whole.alias("whole"))

    return _once(F.trim(masked), counted)


def _keys(x: Column, second: bool) -> Column:
    """Hashes of a line's templates, the whole line (with a last bit of 1) among them; second: structs with another hash behind it."""

    def key(kind: int, last: int, *held: Column) -> Column:
        own = F.xxhash64(F.lit(kind), x["n"], *held)
        own = own.bitwiseOR(F.lit(1)) if last else own.bitwiseAND(F.lit(-2))
        return F.struct(own.alias("k1"), F.xxhash64(*held, x["n"], F.lit(-1 - kind)).alias("k2")) if second else own

    free = [F.when(x["paths"].bitwiseAND(F.lit(1 << k)) != 0, key(k, 0, *(x[f"s{j}"] for j in range(STRETCHES) if j not in path))) for k, path in enumerate(PATHS)]
    whole = F.when(x["whole"].isNotNull(), key(len(PATHS), 1, x["whole"]))
    return F.filter(F.array(*free, whole), lambda k: k.isNotNull())


def lines_of(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, th, lines): the lines of each row as hashes, null for those without tokens."""
    text = F.col(text_col)
    even = F.when(text.rlike(UNEVEN), F.regexp_replace(text, r"[\x20\t\x0B\f\r]+", " ")).otherwise(text)
    return docs.where(text.isNotNull()).select(F.col(id_col).alias("id"), F.xxhash64(text).alias("th"), F.transform(F.split(even, "\n"), _line).alias("lines"))


def _least(key: Column, min_docs: int) -> Column:
    return F.when(key.bitwiseAND(F.lit(1)) == 1, WHOLE_DOCS).otherwise(min_docs)


def _filter_of(held: DataFrame, min_docs: int) -> tuple[DataFrame, int]:
    """(word, bits) of what may recur, and the number of words: the bit of a template's first hash is set if enough rows hold it."""
    own = F.array_distinct(F.flatten(F.transform(F.filter("lines", lambda x: x.isNotNull()), lambda x: _keys(x, False))))
    counted = held.select(F.explode(own).alias("k1")).groupBy("k1").agg(F.count(F.lit(1)).alias("rows")).where(F.col("rows") >= _least(F.col("k1"), min_docs))
    known = materialize(counted.select("k1"), "may-recur", compact=True)
    words = 1
    while words < WORDS and words * 64 < known.count() * BITS_EACH:
        words *= 2
    return known.groupBy(_word(F.col("k1"), words).alias("word")).agg(F.bit_or(_bit(F.col("k1"))).alias("bits")), words


def _word(key: Column, words: int) -> Column:
    return F.shiftrightunsigned(key, 7).bitwiseAND(F.lit(words - 1))


def _bit(key: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), F.shiftright(key, 1).bitwiseAND(F.lit(63)).cast("int"))


def recurring(rows: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """(k1, k2, first) from (k1, k2, id, th): templates that enough documents hold, and the smallest id among those."""
    own = rows.select("k1", "k2", "id", F.when(F.col("id").isNull(), F.col("th"))).distinct()  # within each task before the exchange
    return own.groupBy("k1", "k2").agg(F.count(F.lit(1)).alias("docs"), F.min("id").alias("first")).where(F.col("docs") >= _least(F.col("k1"), min_docs))


def _decided(docs: DataFrame, min_docs: int, id_col: str, text_col: str) -> DataFrame:
    """(doc, id, text, lines, gone, kept_text): each row of docs as a struct, and the places of its lines that go."""
    held = keep(lines_of(docs, id_col, text_col))
    bits, words = _filter_of(held, min_docs)
    every = held.select("id", "th", F.posexplode("lines").alias("pos", "x")).where("x is not null").select("id", "th", "pos", F.inline(_keys(F.col("x"), True)))
    met = every.join(F.broadcast(bits), _word(F.col("k1"), words) == F.col("word")).where(F.col("bits").bitwiseAND(_bit(F.col("k1"))) != 0)
    maybe = keep(met.select("id", "th", "pos", "k1", "k2"))
    known = materialize(recurring(maybe, min_docs), "recurring", compact=True)  # apart, so that Spark can split a hot template in the join
    gone = (
        maybe.join(known.select("k1", "k2", "first").hint("merge"), ["k1", "k2"])
        .where(~F.col("id").eqNullSafe(F.col("first")))
        .groupBy(F.col("id").alias("gone_id"), F.col("th").alias("gone_th"))
        .agg(F.collect_set("pos").alias("gone"))
    )
    others = F.struct(*(F.col(f"`{c}`") for c in docs.columns if c != text_col))
    rows = docs.select(others.alias("doc"), F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.xxhash64(text_col).alias("th"))
    met = rows.join(gone, F.col("id").eqNullSafe(F.col("gone_id")) & (F.col("th") == F.col("gone_th")), "left").withColumn("lines", F.split("text", "\n"))
    stay = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), F.col("gone"))
    kept = F.when(F.col("gone").isNull(), F.col("text")).otherwise(F.array_join(F.transform(stay, lambda i: F.get("lines", i)), "\n"))
    return met.select("doc", "id", "text", "lines", "gone", kept.alias("kept_text"))


def drop_recurring(docs: DataFrame, min_docs: int = MIN_DOCS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, text, n_lines, n_dropped, kept_text) for each row of docs."""
    return _decided(docs, min_docs, id_col, text_col).select(
        F.col("id").alias(id_col),
        F.col("text").alias(text_col),
        F.when(F.col("text").isNull(), 0).otherwise(F.size("lines")).cast("long").alias("n_lines"),
        F.when(F.col("gone").isNull(), 0).otherwise(F.size("gone")).cast("long").alias("n_dropped"),
        "kept_text",
    )


def without_recurring(docs: DataFrame, min_docs: int = MIN_DOCS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs with all columns, their texts without the lines that go."""
    left = _decided(docs, min_docs, id_col, text_col)
    return left.select(*(F.col("kept_text").alias(c) if c == text_col else F.col("doc")[c].alias(c) for c in docs.columns))
