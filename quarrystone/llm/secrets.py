"""Secret scan: fixed patterns, and novelty under zstandard primed with dictionaries.

The patterns of the base find assignments to secret-like names, access keys and
long hexadecimal runs. Beyond them, each long string that stands close to a
sensitive word, behind or before it, is compressed after its surroundings, by a
compressor primed with a dictionary of identifiers: a fixed list of what code says
often, and the words that the corpus's documents share. Further copies of the string,
or of twenty characters of it, are taken out of the surroundings, so that a key that is declared and used close by
does not hide itself. The bytes that it adds to the compressed surroundings, against
those that its own characters add in random order, are its novelty: 1 for a string of
which the dictionary and the surroundings know nothing, less for one that is made of
known words. Strings that stay incompressible are reported as ``novel``, one span for
each string. A string that holds sensitive words is measured stretch by stretch, on
both sides of each word; neighbours that are both novel are one span, the word with
them. Parts joined by dots are one string.

The corpus's words are counted over all documents by Spark; the dictionary holds
the ``WORDS`` that save most, letters only and shorter than any candidate, so that
no key gets into it however often its document is copied.

Defined cases: a null text is an empty one without spans; texts are scanned
whole; offsets count code points, end exclusive; repeated rows give repeated
results; further columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import random
import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..storage import keep, ship

#: The kinds of the base in their order.
KINDS = ("assign", "access", "hex", "novel")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")  # the runs of [0-9a-f]+ with 24 characters or more

SENSITIVE = re.compile(r"passw|secret|token|api.?key|access.?key|private.?key|auth|cred|bearer|signature", re.IGNORECASE | re.ASCII)
LEAST = 20  # characters of a candidate
CANDIDATE = re.compile(rf"[A-Za-z0-9+/_=-][A-Za-z0-9+/_=.-]{{{LEAST - 2},}}[A-Za-z0-9+/_=-]")
REACH = 80  # characters between a sensitive word and a candidate
WORDS = 3000  # words of the corpus in the dictionary, about
WORD = r"[A-Za-z][A-Za-z_]{3,18}(?![A-Za-z_])"
AROUND = 256  # characters of the surroundings on either side
NOVELTY = 0.95  # share of the bytes that the same characters add in random order
SHUFFLES = 3  # random orders that are measured
LEAST_BITS = 2.0  # bits that each character adds at least, lest uniform strings count, which have no order to lose
LEVEL = 12

IDENTIFIERS = """
password passwd secret token api_key apikey access_key private_key authorization bearer credential credentials
username user_name user_id session_id client_id client_secret refresh_token access_token id_token signature public_key
configuration connection_string database hostname endpoint environment production development staging default localhost
function return const static public private protected class import export require module package include define string
integer boolean number object array null undefined true false none self this value values name names type types index
length offset buffer stream reader writer request response header headers content content_type application json xml html
the and that with from this have are was not for you they which there their would about other into could first after
abcdefghijklmnopqrstuvwxyz ABCDEFGHIJKLMNOPQRSTUVWXYZ 0123456789 aaaaaaaaaaaaaaaa 0000000000000000 xxxxxxxxxxxxxxxx
authentication authorization authenticator manager builder provider service serialization deserialization exception factory
repository controller application documentation implementation information management organization administration
international internationalization localization transformation representation characterization responsibility
responsibilities communication infrastructure interface component resource document template properties security encryption
user_authentication_service getUserAuthenticationProvider AuthenticationManagerBuilder AuthorizationServiceFactory
UserManager SecurityContext ExceptionHandler SerializationException src/main/java/ src/test/ usr/share/ usr/local/lib/ var/log/
etc/ home/ node_modules/ Datenschutzgrundverordnung gesellschaft versicherung verwaltung verordnung genehmigung
administración información comunicación responsabilidades développement gouvernement constitutionnel
example.com example.org http:// https:// www. .com .org .net -----BEGIN -----END CERTIFICATE
"""


class NoveltyMeter:
    """Marginal compressed bytes of a string against its surroundings."""

    def __init__(self, words: list[str] | None = None, level: int = LEVEL) -> None:
        import zstandard

        dictionary = " ".join(words or []) + IDENTIFIERS  # what stands nearer to the end costs less to refer to
        primed = zstandard.ZstdCompressionDict(dictionary.encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        primed.precompute_compress(level=level)
        self.size = lambda data, c=zstandard.ZstdCompressor(dict_data=primed, write_content_size=False): len(c.compress(data))

    def novelty(self, before: str, text: str, after: str) -> float:
        near = (before + "\n" + after + "\n").encode()
        known = self.size(near)
        added = self.size(near + text.encode()) - known
        if added * 8 < LEAST_BITS * len(text):
            return 0.0
        draw, letters, apart = random.Random(text), list(text), 0  # the same orders wherever the string stands
        for _ in range(SHUFFLES):
            draw.shuffle(letters)
            apart += self.size(near + "".join(letters).encode()) - known
        return added * SHUFFLES / max(1, apart)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of what the fixed patterns find."""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


def candidates(text: str) -> Iterator[list[tuple[int, int]]]:
    """Long strings close to a sensitive word, each as its stretches between the sensitive words that it holds."""
    words: list[tuple[int, int]] | None = None
    for run in CANDIDATE.finditer(text):
        if words is None:
            words = [m.span() for m in SENSITIVE.finditer(text)]
            starts, ends = [w[0] for w in words], [w[1] for w in words]
        start, end = run.span()
        first, behind = bisect_right(ends, start), bisect_left(starts, end)  # words[first:behind] meet the run
        if first < behind:
            edges = [start, *(x for k in range(first, behind) for x in (max(start, starts[k]), min(end, ends[k]))), end]
            yield [(a, b) for a, b in zip(edges[::2], edges[1::2], strict=True) if b - a >= LEAST]
        elif first and start - ends[first - 1] <= REACH or behind < len(words) and starts[behind] - end <= REACH:
            yield [(start, end)]


def surroundings(text: str, start: int, end: int, reach: int = AROUND) -> tuple[str, str]:
    """What stands before and behind a string, without copies of it or of LEAST characters of it; those that the border cuts go, too."""
    own, half = text[start:end], LEAST // 2

    def without(low: int, high: int) -> str:
        # LEAST characters that are shared hold one of these blocks
        if not any(text[i : i + half] in own for i in range(max(0, low - LEAST + 1), high + half, half + 1)):
            return text[low:high]
        kept, at = [], low
        for i in range(max(0, low - LEAST + 1), min(high, len(text) - LEAST + 1)):
            if text[i : i + LEAST] in own:
                kept.append(text[at:i])  # nothing where copies meet
                at = max(at, min(high, i + LEAST))
        return "".join(kept) + text[at:high]

    return without(max(0, start - reach), start), without(end, min(len(text), end + reach))


def novel_spans(text: str, meter: NoveltyMeter) -> list[tuple[int, int, int]]:
    """(start, kind, end) of incompressible strings close to a sensitive word."""
    found: list[tuple[int, int, int]] = []
    for stretches in candidates(text):
        last = None  # the stretch before, if it is novel
        for s, e in stretches:
            before, after = surroundings(text, s, e)
            novel = meter.novelty(before, text[s:e], after) >= NOVELTY
            if novel and last is not None and SENSITIVE.fullmatch(text, last, s):
                found[-1] = (found[-1][0], 3, e)
            elif novel:
                found.append((s, 3, e))
            last = e if novel else None
    return found


def corpus_words(docs: DataFrame, text_col: str = "text", most: int = WORDS) -> list[str]:
    """About the `most` words that save most bytes, by the number of documents that hold them and their length; at least two documents do.

    How many words save how much is counted first, in steps of a twentieth or so,
    so that no more than the dictionary's own words ever come to the driver; of
    the last step, which has too many, a hash chooses.
    """
    held = docs.select(F.explode(F.array_distinct(F.regexp_extract_all(text_col, F.lit(WORD), F.lit(0)))).alias("word"))
    counted = held.groupBy("word").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    scored = keep(counted.select("word", (F.col("n") * F.length("word")).alias("score"), F.floor(F.log2(F.col("n") * F.length("word")) * 16).cast("int").alias("step")))
    room, last, share = most, None, 1.0
    for r in sorted(scored.groupBy("step").agg(F.count(F.lit(1)).alias("words")).collect(), key=lambda r: -r.step):  # a thousand steps at most
        last, share = r.step, room / r.words
        if r.words >= room:
            break
        room -= r.words
    few = F.pmod(F.xxhash64("word"), F.lit(1 << 20)) < F.lit(int(min(1.0, share) * (1 << 20)))
    best = [] if last is None else scored.where((F.col("step") > last) | (F.col("step") == last) & few).collect()
    scored.unpersist()
    return [r.word for r in sorted(best, key=lambda r: (r.score, r.word))]


def _line(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: list[str] | None = None) -> DataFrame:
    """(id, n_assign, n_access, n_hex, n_novel, base_spans, spans) for each row of docs; words: a dictionary in place of the corpus's own."""
    ship(docs.sparkSession)
    known = corpus_words(docs, text_col) if words is None else words
    names = [id_col, "n_assign", "n_access", "n_hex", "n_novel", "base_spans", "spans"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        meter = NoveltyMeter(known)
        for b in batches:
            counts: list[list[int]] = [[], [], [], []]
            base, every = [], []
            for text in b[1].to_pylist():
                own = base_spans(text or "")
                extra = novel_spans(text or "", meter)
                for k in range(4):
                    counts[k].append(sum(1 for x in own + extra if x[1] == k))
                base.append(_line(own))
                every.append(_line(sorted(own + extra)))
            yield pa.record_batch([b[0], *(pa.array(c, pa.int64()) for c in counts), pa.array(base, pa.string()), pa.array(every, pa.string())], names)

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {kind}, n_assign long, n_access long, n_hex long, n_novel long, base_spans string, spans string")
