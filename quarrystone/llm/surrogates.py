"""PII: keyed surrogates that keep type, format, script and gender.

DataFrame functions only. One search marks all entities of a text. Words of names
found so are then marked wherever else the same text has them alone, so that a
person who is named once stays one person. What stands in the context of a name in
several documents, and in few others, is learnt as a name: texts that have a learnt
word among capitalised ones are searched again for it and for the surname behind a
learnt given name. Each distinct entity (in a normal form,
so that all its spellings agree) gets a surrogate:

* mails, phones, social security, card and bank account numbers by a keyed
  permutation of the strings of the same form (a Feistel network whose rounds
  shift the characters of one half, each within its own alphabet, by a digest of
  the other half). Top-level domains, country codes and the first digit of cards
  stay. Check digits are made again: valid numbers stay valid, others invalid;
* addresses of machines by a keyed permutation of all 32-bit numbers, or 128-bit ones;
* names by syllables of the same script drawn from a keyed digest, with an ending
  of the same gender, longer with each round of drawing; each part of a name with
  hyphens by its own, while particles (van, de, O') stay.

A permutation never gives two entities one surrogate. Surrogates are checked
against each other and against all entities of the corpus; who collides draws
again. What still collides after ``MOST_ROUNDS`` takes the plain permutation,
which differs from every other surrogate though it is an entity of the corpus
elsewhere (only in a space of numbers that the corpus nearly fills), and names
take all syllables of their digest. So every draw ends.

Only entities travel; texts with entities move once to meet their surrogates, and
texts without any don't move.

Defined cases: null texts stay null and empty texts empty; repeated rows get equal
results; an entity that stands in very many rows is counted before the exchange;
private-use characters in texts are kept; further columns are ignored; an empty
table gives an empty result. Patterns take time in proportion to a text's length.

Not found: names whose words no document of the corpus has behind a title, a label
or a listed given name; numbers of phones in other forms than: a + sign, a leading
zero, the North American form, eight digits in pairs or as 3-2-3.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..storage import keep, materialize

MOST_ROUNDS = 6
FEISTEL_ROUNDS = 4

#: Titles and given names by gender, and the parts of surrogate names by script.
TITLES_F = ("Mrs", "Ms", "Miss", "Frau", "Mme", "Madame", "Señora", "Sra")
TITLES_M = ("Mr", "Herr", "Monsieur", "Señor", "Sr")
TITLES_U = ("Dr", "Prof", "Professor")
GIVEN_F = ("Anna", "Maria", "Emma", "Julia", "Laura", "Sophie", "Marie", "Claire", "Carmen", "Lucia", "Elena", "Sarah", "Emily", "Mary", "Jennifer", "Elizabeth", "Angela", "Priya", "Ольга", "Анна", "Мария", "Елена", "Ελένη", "Μαρία")
GIVEN_M = ("John", "James", "Robert", "Michael", "William", "David", "Thomas", "Peter", "Hans", "Klaus", "Pierre", "Jean", "Carlos", "Juan", "Pedro", "Miguel", "Иван", "Сергей", "Дмитрий", "Алексей", "Γιώργος", "Νίκος")
PARTICLES = ("van", "von", "der", "den", "de", "di", "da", "del", "della", "dos", "la", "le", "al", "el", "bin", "ibn", "ter", "zu", "af")
LABELS = ("[Nn]ame: ", "[Nn]ame is ", "[Cc]ontact: ", "[Aa]uthor: ", "[Ss]igned: ", "[Aa]ttn: ")
SYLLABLES = {
    "latin": ("ba", "ce", "di", "fo", "ga", "he", "ki", "lo", "ma", "ne", "pi", "ro", "sa", "te", "vi", "zo"),
    "cyrillic": ("ба", "ве", "ги", "до", "жа", "зе", "ки", "ло", "ма", "не", "пи", "ро", "са", "те", "фи", "хо"),
    "greek": ("βα", "γε", "δι", "ζο", "θα", "κε", "λι", "μο", "να", "ξε", "πι", "ρο", "σα", "τε", "φι", "χο"),
}
ENDINGS = {
    "latin": {"f": "lina", "m": "nard", "u": "ris", "s": "sen"},
    "cyrillic": {"f": "лина", "m": "слав", "u": "рис", "s": "ский"},
    "greek": {"f": "ίνα", "m": "άνδρος", "u": "ιδα", "s": "ίδης"},
}
#: Alphabets as ranges of code points; letters outside of them stay within their block of 16.
ALPHABETS = (("0", "9"), ("a", "z"), ("A", "Z"), ("à", "ö"), ("ø", "þ"), ("α", "ω"), ("Α", "Ρ"), ("Σ", "Ω"), ("а", "я"), ("А", "Я"), ("א", "ת"), ("ぁ", "ゖ"), ("ァ", "ヺ"), ("一", "鿿"), ("가", "힣"))
#: Country codes of one and two digits in phone numbers; all others have three.
COUNTRY_CODE = r"^\+(?:[17]|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|[0-9]{1,3})"

_OCTET = r"(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
_NO_BEFORE, _NO_AFTER = r"(?<![\p{L}\p{N}])", r"(?![\p{L}\p{N}])"
#: A word of a name: capitals within it, all capitals, parts behind hyphens and apostrophes.
_WORD = r"\p{Lu}(?:[\p{L}\p{M}]++(?:['’-]\p{Lu}[\p{L}\p{M}]*+){0,3}+|(?:['’]\p{Lu}[\p{L}\p{M}]*+){1,3}+)"
_NEXT = rf"(?: (?:{'|'.join(PARTICLES)})(?= )){{0,3}}+ {_WORD}"
_HEX = "[0-9a-fA-F]{1,4}"
_LABEL = r"[\p{L}\p{N}-]++"
PATTERNS = {
    # begun where a run of its characters begins and never given back, so that long runs cost no more than their length
    "email": rf"(?<![\p{{L}}\p{{N}}._%+-])[._%+-]*+[\p{{L}}\p{{N}}][\p{{L}}\p{{N}}._%+-]*+@(?=[\p{{L}}\p{{N}}.-]*?\.\p{{L}}{{2}}){_LABEL}(?:\.{_LABEL})++",
    "ip": rf"(?<![\p{{L}}\p{{N}}.])(?:{_OCTET}\.){{3}}{_OCTET}(?![\p{{L}}\p{{N}}]|\.[0-9])",
    "ip6": rf"(?<![\p{{L}}\p{{N}}:.])(?=[0-9a-fA-F:]*?[0-9])(?:(?:{_HEX}:){{7}}{_HEX}|{_HEX}(?::{_HEX}){{0,5}}::(?:{_HEX}(?::{_HEX}){{0,5}})?)(?![\p{{L}}\p{{N}}:])",
    "phone": rf"\+[0-9]{{1,3}}[ .-]?(?:\([0-9]{{1,4}}\)[ .-]?)?[0-9]{{2,5}}(?:[ .-]?[0-9]{{2,4}}){{1,4}}{_NO_AFTER}"
    rf"|{_NO_BEFORE}(?:1[ .-]?)?\([0-9]{{3}}\) ?[0-9]{{3}}-[0-9]{{4}}{_NO_AFTER}|{_NO_BEFORE}[0-9]{{3}}[.-][0-9]{{3}}[.-][0-9]{{4}}{_NO_AFTER}"
    rf"|{_NO_BEFORE}0[1-9](?:[ .-][0-9]{{2}}){{4}}{_NO_AFTER}|{_NO_BEFORE}0[1-9][0-9]{{1,3}}[ /-][0-9]{{5,8}}{_NO_AFTER}"
    rf"|{_NO_BEFORE}0[1-9][0-9]{{1,3}}(?:[ -][0-9]{{3,4}}){{2}}{_NO_AFTER}|{_NO_BEFORE}\(0[1-9][0-9]{{1,3}}\) ?[0-9]{{3,4}}(?:[ -]?[0-9]{{3,4}}){{1,2}}{_NO_AFTER}"
    rf"|(?<![0-9] ){_NO_BEFORE}(?:[2-9][0-9](?: [0-9]{{2}}){{3}}|[49][0-9]{{2}} [0-9]{{2}} [0-9]{{3}}){_NO_AFTER}(?! [0-9])",
    "ssn": rf"{_NO_BEFORE}[0-9]{{3}}-[0-9]{{2}}-[0-9]{{4}}{_NO_AFTER}",
    "card": rf"{_NO_BEFORE}[0-9](?:[ -]?[0-9]){{12,18}}{_NO_AFTER}",
    "iban": rf"{_NO_BEFORE}[A-Z]{{2}}[0-9]{{2}}(?: ?[A-Z0-9]{{4}}){{3,7}}(?: ?[A-Z0-9]{{1,3}})?{_NO_AFTER}",
    "name": rf"{_NO_BEFORE}(?:(?:{'|'.join(TITLES_F + TITLES_M + TITLES_U)})\.? {_WORD}(?:{_NEXT})?|(?:{'|'.join(GIVEN_F + GIVEN_M)})(?:-\p{{Lu}}[\p{{L}}\p{{M}}]*+){{0,2}}+{_NEXT}|(?<={'|'.join(LABELS)}){_WORD}{_NEXT}){_NO_AFTER}",
}
_UNION = lambda *kinds: "|".join(f"(?:{PATTERNS[k]})" for k in kinds)
#: All patterns in their order, those that cannot begin at a character left out by a glance at it.
ENTITY = rf"(?:(?<![\p{{L}}\p{{N}}])|(?=\+))(?:{_UNION('email')}|(?=[0-9(+])(?:{_UNION('ip', 'phone', 'ssn', 'card')})|(?=[0-9a-fA-F])(?:{_UNION('ip6')})|(?=\p{{Lu}})(?:{_UNION('iban', 'name')}))"
CAPITALISED = rf"{_NO_BEFORE}\p{{Lu}}[\p{{L}}\p{{M}}]++{_NO_AFTER}"
RUN = rf"{_NO_BEFORE}{_WORD}(?: {_WORD})++{_NO_AFTER}"  # capitalised words behind each other
NAME_ONLY = r"^[\p{L}\p{M}. '’-]+$"
PIECES = r"(?<=[ '’-])"  # between the parts of a name, each with what divides it from the next
NAME_KINDS = ("name_s", "name_f", "name_m", "name_u")

#: Marks around entities. A private-use character of a text that could be taken for one gets an escape behind it.
_P = "\ue000"
SEP, WORD_SEP, ESCAPED = _P + "\ue001", _P + "\ue002", _P + "\ue003"


def _once(value: Column, then) -> Column:  # noqa: ANN001
    """then(value), with the value made once."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


def _kind(entity: Column) -> Column:
    kind = F.when(entity.rlike(NAME_ONLY), "name")
    for k, p in PATTERNS.items():
        kind = kind.when(entity.rlike(rf"^(?:{p})$"), k)
    return kind.otherwise("name")


def _gender(entity: Column) -> Column:
    begins = lambda titles, given: entity.rlike(rf"^(?:{'|'.join(titles)})\b|^(?:{'|'.join(given)})[ -]")
    return F.when(begins(TITLES_F, GIVEN_F), "f").when(begins(TITLES_M, GIVEN_M), "m").otherwise("u")


def _norm_name(word: Column) -> Column:
    return F.initcap(F.lower(word))


def _without_title(entity: Column) -> Column:
    return F.regexp_replace(entity, rf"^(?:{'|'.join(TITLES_F + TITLES_M + TITLES_U)})\.? ", "")


def _escaped(text: Column) -> Column:
    return F.replace(text, F.lit(_P), F.lit(ESCAPED))


def marked(text: Column, more: Column | None = None) -> Column:
    """(m, names): an escaped text with marks around its entities, and the words of names that it holds as `` kind:Word ... ``.

    more: further words of names, in that form.
    """
    searched = F.regexp_replace(text, ENTITY, f"{SEP}$0{SEP}")

    def words_of(entity: Column) -> Column:
        words = F.filter(F.split(_without_title(entity), "[ '’-]"), lambda w: w.rlike(r"^\p{Lu}."))
        kind = lambda i: F.when(i == F.size(words) - 1, F.lit("name_s")).otherwise(F.concat(F.lit("name_"), _gender(entity)))
        return F.transform(words, lambda w, i: F.concat(kind(i), F.lit(":"), _norm_name(w)))

    def mentions(gap: Column, names: Column) -> Column:
        parts = F.split(F.regexp_replace(gap, CAPITALISED, f"{WORD_SEP}$0{WORD_SEP}"), WORD_SEP)
        return F.array_join(F.transform(parts, lambda w, j: F.when((j % 2 == 1) & _held(names, w).isNotNull(), F.concat(F.lit(SEP), w, F.lit(SEP))).otherwise(w)), "")

    def with_mentions(x: Column) -> Column:
        again = F.array_join(F.transform(x["p"], lambda p, i: F.when(i % 2 == 0, mentions(p, x["n"])).otherwise(p)), SEP)
        return F.struct(F.when(x["n"] != "", again).otherwise(F.array_join(x["p"], SEP)).alias("m"), x["n"].alias("names"))

    def with_names(p: Column) -> Column:
        names = F.filter(p, lambda e, i: (i % 2 == 1) & e.rlike(NAME_ONLY))
        words = F.array_distinct(F.flatten(F.transform(names, words_of)))
        own = F.when(F.size(words) > 0, F.concat(F.lit(" "), F.array_join(words, " "), F.lit(" "))).otherwise("")
        return _once(F.struct(p.alias("p"), (own if more is None else F.concat(own, more)).alias("n")), with_mentions)

    if more is not None:
        return _once(F.split(searched, SEP, -1), with_names)
    plain = F.struct(F.lit(None).cast("string").alias("m"), F.lit("").alias("names"))
    return _once(searched, lambda s: F.when(F.contains(s, F.lit(SEP)), _once(F.split(s, SEP, -1), with_names)).otherwise(plain))


LEAST_DOCS = 2  # documents that show a learnt word in the context of a name
LEAST_SHARE = 0.5  # of the documents that have it capitalised at all
FEW_NAMES = 100_000  # so many learnt words are sent to all tasks, more are shuffled


def learnt(searched: DataFrame) -> DataFrame | None:
    """(word, kind): words that stand in the context of names; None if there are none.

    searched: (text, names, ...) as pseudonymise has them, texts with marks.
    """
    told = searched.where("names != ''").select(F.explode(F.array_distinct(F.split(F.trim("names"), " +"))).alias("x"))
    pairs = told.groupBy("x").agg(F.count(F.lit(1)).alias("n")).select(F.substring_index("x", ":", 1).alias("kind"), F.substring_index("x", ":", -1).alias("word"), "n")
    words = pairs.groupBy("word").agg(F.max_by("kind", F.struct("n", "kind")).alias("kind"), F.sum("n").alias("named")).where((F.col("named") >= LEAST_DOCS) & (F.length("word") > 1))
    words = materialize(words, "names", compact=True)
    n = words.count()
    if not n:
        return None
    held = searched.select(F.explode(F.array_distinct(F.transform(F.regexp_extract_all("text", F.lit(CAPITALISED), F.lit(0)), _norm_name))).alias("word"))
    seen = held.join(F.broadcast(words) if n <= FEW_NAMES else words, "word").groupBy("word", "kind", "named").agg(F.count(F.lit(1)).alias("docs"))
    return materialize(seen.where(F.col("named") >= LEAST_SHARE * F.col("docs")).select("word", "kind"), "learnt", compact=True)


def _beside(searched: DataFrame, names: DataFrame) -> DataFrame:
    """(ik, th, more): learnt words among capitalised ones, and surnames behind learnt given names, of each row that has any outside of its entities."""
    gaps = F.array_join(F.filter(F.split("text", SEP, -1), lambda p, i: i % 2 == 0), "\n")
    runs = searched.select("ik", "th", F.explode(F.array_distinct(F.regexp_extract_all(F.when(F.col("has"), gaps).otherwise(F.col("text")), F.lit(RUN), F.lit(0)))).alias("run"))
    words = runs.select("ik", "th", F.split("run", "[ '’-]").alias("words"))
    each = words.select("ik", "th", F.inline(F.transform("words", lambda w, i: F.struct(_norm_name(w).alias("word"), F.get("words", i + 1).alias("after")))))  # no row holds a whole run
    few = names.count() <= FEW_NAMES
    met = each.join(F.broadcast(names) if few else names, "word")
    after = F.col("after")
    surname = F.when((F.col("kind") != "name_s") & F.coalesce(F.length(after) > 1, F.lit(False)), F.concat(F.lit("name_s:"), _norm_name(after)))
    found = met.select("ik", "th", F.explode(F.array_compact(F.array(F.concat("kind", F.lit(":"), "word"), surname))).alias("x"))
    return found.groupBy("ik", "th").agg(F.concat(F.lit(" "), F.array_join(F.array_sort(F.collect_set("x")), " "), F.lit(" ")).alias("more"))


def _held(names: Column, word: Column) -> Column:
    """The kind under which a word stands among names; null if it doesn't."""
    kind = F.when(F.lit(False), "")
    for k in NAME_KINDS:
        kind = kind.when(F.contains(names, F.concat(F.lit(f" {k}:"), _norm_name(word), F.lit(" "))), k)
    return kind


def _number(key: str, *parts: Column) -> Column:
    """A keyed number of 60 bits."""
    return F.conv(F.substring(F.sha2(F.concat_ws("|", F.lit(key), *parts), 256), 1, 15), 16, 10).cast("long")


def _shifted(c: Column, by: Column) -> Column:
    """The code point that stands `by` places behind c in its alphabet, around its end; signs stay."""
    out = F.when(c < 0x30, c)
    for lo, hi in ALPHABETS:
        size = ord(hi) - ord(lo) + 1
        out = out.when((c >= ord(lo)) & (c <= ord(hi)), (c - ord(lo) + by % size) % size + ord(lo))
    return out.when(c < 0xC0, c).otherwise(c - c % 16 + (c + by % 16) % 16)


def permuted(text: Column, key: str, tweak: Column) -> Column:
    """A keyed permutation of the strings that have the same alphabets at the same places."""

    def round_of(r: int):  # noqa: ANN202
        def one(x: Column) -> Column:
            moved, other = (x["a"], x["b"]) if r % 2 == 0 else (x["b"], x["a"])
            seed = F.sha2(F.concat_ws("|", F.lit(key), tweak, F.lit(str(r)), F.array_join(F.transform(other, lambda c: c.cast("string")), ",")), 256)
            new = _once(seed, lambda s: F.transform(moved, lambda c, i: _shifted(c, F.conv(F.substring(F.sha2(F.concat_ws("|", s, i.cast("string")), 256), 1, 12), 16, 10).cast("long")).cast("int")))
            return F.struct((new if r % 2 == 0 else x["a"]).alias("a"), (x["b"] if r % 2 == 0 else new).alias("b"))

        return one

    half = lambda cs: F.floor(F.size(cs) / 2).cast("int")
    points = F.transform(F.split(text, ""), lambda c: F.ascii(c))
    state = _once(points, lambda cs: F.struct(F.slice(cs, F.lit(1), half(cs)).alias("a"), F.slice(cs, half(cs) + 1, F.size(cs)).alias("b")))
    for r in range(FEISTEL_ROUNDS):
        state = _once(state, round_of(r))
    written = lambda cs: F.array_join(F.transform(cs, lambda c: F.lpad(F.hex(c.cast("long")), 8, "0")), "")
    joined = _once(state, lambda x: F.decode(F.unhex(F.concat(written(x["a"]), written(x["b"]))), "UTF-32"))
    return F.when(text == "", text).otherwise(joined)


def _luhn(digits: Column) -> Column:
    """Sum of the check over all digits, modulo 10."""
    n = F.length(digits)
    value = lambda i: F.substring(digits, n - i, F.lit(1)).cast("int")
    twice = lambda i: F.when(i % 2 == 1, F.when(value(i) > 4, value(i) * 2 - 9).otherwise(value(i) * 2)).otherwise(value(i))
    return F.aggregate(F.sequence(F.lit(0), n - 1), F.lit(0), lambda a, i: a + twice(i)) % 10


def _iban_check(country: Column, body: Column) -> Column:
    """The two check digits that a bank account number ought to have."""
    step = lambda a, c: F.when(c.rlike("[0-9]"), (a * 10 + c.cast("int")) % 97).otherwise((a * 100 + F.ascii(c) - 55) % 97)
    rest = F.aggregate(F.split(F.concat(body, country, F.lit("00")), ""), F.lit(0), step)
    return F.lpad((F.lit(98) - rest).cast("string"), 2, "0")


def _core(kind: Column, norm: Column, attempt: Column, key: str) -> Column:
    """The surrogate of a normal form, for each attempt another one."""
    tweak = F.concat_ws("|", kind, attempt.cast("string"))
    end = F.length(norm)
    after = lambda text, n: F.substring(text, n + 1, F.length(text))

    top = F.regexp_extract(norm, r"\.(\p{L}{2,63})$", 0)  # with its dot; empty where the last label isn't one
    code = F.regexp_extract(norm, COUNTRY_CODE, 0)
    country, check, account = F.substring(norm, 1, 2), F.substring(norm, 3, 2), F.substring(norm, F.lit(5), end)
    part = (  # what the permutation takes of a normal form, one for all kinds
        F.when(kind == "email", F.substring(norm, F.lit(1), end - F.length(top)))
        .when(kind == "phone", after(norm, F.length(code)))
        .when(kind == "card", F.substring(norm, F.lit(2), end - 2))
        .when(kind == "iban", account)
        .when(kind.isin("ip", "ip6") | kind.startswith("name_"), "")
        .otherwise(norm)
    )

    octet = lambda i: F.get(F.split(norm, r"\."), F.lit(i)).cast("long")
    high, low = octet(0) * 256 + octet(1), octet(2) * 256 + octet(3)
    for r in range(FEISTEL_ROUNDS):  # two halves of 16 bits
        high, low = low, high.bitwiseXOR(_number(key, tweak, F.lit(str(r)), low.cast("string")) % 65536)
    ip = F.concat_ws(".", *((F.floor(x / 256) % 256).cast("string") if part == 0 else (x % 256).cast("string") for x in (high, low) for part in (0, 1)))

    def mixed(r: int):  # noqa: ANN202
        part = lambda x: F.transform(x["a"], lambda g, i: g.bitwiseXOR(_number(key, tweak, F.lit(str(r)), i.cast("string"), F.array_join(x["b"], ":")) % 65536))
        return lambda x: F.struct(x["b"].alias("a"), part(x).alias("b"))

    groups = F.transform(F.split(norm, ":"), lambda g: F.conv(g, 16, 10).cast("long"))
    state = F.struct(F.slice(groups, 1, 4).alias("a"), F.slice(groups, 5, 4).alias("b"))
    for r in range(FEISTEL_ROUNDS):  # two halves of four groups of 16 bits
        state = _once(state, mixed(r))
    ip6 = _once(state, lambda x: F.array_join(F.transform(F.concat(x["a"], x["b"]), lambda g: F.lower(F.hex(g))), ":"))

    # what a card's last digit lacks to the check sum is kept, and so is whether it is valid
    card = lambda b: F.concat(b, F.pmod(_luhn(norm) - _luhn(F.concat(b, F.lit("0"))), F.lit(10)).cast("string"))

    def bank(x: Column) -> Column:
        was, ought = _iban_check(country, account), _iban_check(country, x)
        return F.concat(country, F.when(check == was, ought).when(check == ought, was).otherwise(check), x)

    script = F.when(norm.rlike(r"\p{IsCyrillic}"), "cyrillic").when(norm.rlike(r"\p{IsGreek}"), "greek").otherwise("latin")
    digest = F.sha2(F.concat_ws("|", F.lit(key), F.lit("name"), kind, attempt.cast("string"), norm), 256)
    length = F.when(attempt < MOST_ROUNDS, 4 + 2 * attempt).otherwise(64)  # syllables
    spelt = lambda s: F.array_join(F.transform(F.split(F.substring(digest, F.lit(1), length), ""), lambda c: F.get(F.array(*(F.lit(x) for x in SYLLABLES[s])), F.conv(c, 16, 10).cast("int"))), "")
    name = F.when(F.lit(False), "")
    for s, endings in ENDINGS.items():
        for gender, ending in endings.items():
            name = name.when((kind == f"name_{gender}") & (script == s), F.initcap(F.concat(spelt(s), F.lit(ending))))

    def told(p: Column) -> Column:
        return (
            F.when(kind == "email", F.concat(p, top, F.lit(".example")))
            .when(kind == "ip", ip)
            .when(kind == "ip6", ip6)
            .when(kind == "phone", F.concat(code, p))
            .when(kind == "card", _once(F.concat(F.substring(norm, 1, 1), p), card))
            .when(kind == "iban", bank(p))
            .when(kind.startswith("name_"), name)
            .otherwise(p)
        )

    return _once(permuted(part, key, tweak), told)


def _dressed(kind: Column, original: Column, core: Column) -> Column:
    """The surrogate in the spelling of an occurrence: its case and its separators."""
    letters = F.regexp_replace(core, r"[^\p{L}\p{N}]", "")
    walk = F.aggregate(
        F.split(original, ""),
        F.struct(F.lit("").alias("out"), F.lit(0).alias("i")),
        lambda a, c: F.when(c.rlike(r"[\p{L}\p{N}]"), F.struct(F.concat(a["out"], F.substring(letters, a["i"] + 1, F.lit(1))).alias("out"), (a["i"] + 1).alias("i"))).otherwise(F.struct(F.concat(a["out"], c).alias("out"), a["i"].alias("i"))),
        lambda a: a["out"],
    )
    cased = F.when((original == F.upper(original)) & (F.lower(original) != original), F.upper(core)).otherwise(core)
    lead = F.regexp_extract(original, r"^[._%+-]*", 0)
    return F.when(kind.isin("phone", "ssn", "card", "iban"), walk).when(kind == "email", F.concat(lead, cased)).otherwise(cased)


def _spelt_out(address: Column) -> Column:
    """Eight groups of an address of 128 bits, without zeros in front."""
    sides = F.split(address, "::", -1)
    groups = lambda x: F.filter(F.split(x, ":"), lambda g: g != "")
    left, right = groups(F.get(sides, F.lit(0))), groups(F.coalesce(F.get(sides, F.lit(1)), F.lit("")))
    every = F.concat(left, F.array_repeat(F.lit("0"), (F.lit(8) - F.size(left) - F.size(right)).cast("int")), right)
    return F.array_join(F.transform(every, lambda g: F.lower(F.hex(F.conv(g, 16, 10).cast("long")))), ":")


def _tokens(found: DataFrame) -> DataFrame:
    """Entities of rows (ik, th, e, entity, names) as tokens (ik, th, e, sub, etype, original, kind, norm); a null kind stays as it is."""
    kinds = found.withColumn("etype", _kind(F.col("entity")))
    entity, named = F.col("entity"), F.col("etype") == "name"
    split = F.when(named, F.split("entity", PIECES)).otherwise(F.array("entity"))
    whole = kinds.select("ik", "th", "e", "etype", "names", F.when(named, _gender(entity)).alias("gender"), split.alias("pieces")).withColumn("n", F.size("pieces"))
    parts = whole.select("ik", "th", "e", "etype", "names", "gender", "n", F.posexplode("pieces").alias("sub", "piece"))
    end = F.when(F.col("etype") == "name", F.regexp_extract("piece", "[ '’-]$", 0)).otherwise("")
    parts = parts.withColumn("sep", end).withColumn("original", F.when(F.col("sep") != "", F.substring("piece", F.lit(1), F.length("piece") - 1)).otherwise(F.col("piece")))
    original = F.col("original")
    title = (F.col("n") > 1) & (F.col("sub") == 0) & F.rtrim(original, F.lit(".")).isin(*TITLES_F, *TITLES_M, *TITLES_U)
    small = ~original.rlike(r"^\p{Lu}.")  # particles, and the O of O'Brien
    name_kind = (
        F.when(title | (small & (F.col("n") > 1)), F.lit(None))
        .when(F.col("n") == 1, _held(F.col("names"), original))
        .when(F.col("sub") == F.col("n") - 1, "name_s")
        .otherwise(F.concat(F.lit("name_"), F.col("gender")))
    )
    kind = F.when(F.col("etype") == "name", name_kind).otherwise(F.col("etype"))
    norm = (
        F.when(F.col("etype").isin("phone", "ssn", "card", "iban"), F.regexp_replace(original, r"[^\p{L}\p{N}+]", ""))
        .when(F.col("etype") == "email", F.regexp_replace(F.lower(original), r"^[._%+-]+", ""))
        .when(F.col("etype") == "ip", F.array_join(F.transform(F.split(original, r"\."), lambda x: x.cast("int").cast("string")), "."))
        .when(F.col("etype") == "ip6", _spelt_out(original))
        .when(F.col("etype") == "name", _norm_name(original))
        .otherwise(original)
    )
    return parts.select("ik", "th", "e", "sub", "sep", "etype", "original", kind.alias("kind"), norm.alias("norm"))


def _family(kind: Column) -> Column:
    """Kinds among which surrogates and entities must differ."""
    return F.when(kind.startswith("name_"), "name").otherwise(kind)


def dictionary(entities: DataFrame, key: str) -> DataFrame:
    """(kind, norm, core) for distinct (kind, norm): all cores of a kind differ, and none is an entity of the corpus where there is room."""
    spread = max(1, int(entities.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    known = materialize(entities.where("kind is not null").select("kind", "norm").distinct(), "entities", compact=True)
    real = known.select(_family(F.col("kind")).alias("family"), F.col("norm").alias("core")).distinct()
    todo, done = known, None
    for attempt in range(MOST_ROUNDS):
        drawn = todo.repartition(spread, "kind", "norm").withColumn("core", _core(F.col("kind"), F.col("norm"), F.lit(attempt), key)).withColumn("family", _family(F.col("kind")))
        drawn = materialize(drawn, "drawn", compact=True)
        first = drawn.groupBy("family", "core").agg(F.min(F.struct("kind", "norm")).alias("x"))
        good = first.join(real, ["family", "core"], "left_anti")
        if done is not None:
            good = good.join(done.select(_family(F.col("kind")).alias("family"), "core"), ["family", "core"], "left_anti")
        good = materialize(good.select("x.kind", "x.norm", "core"), "accepted", compact=True)
        done = good if done is None else done.unionByName(good)
        todo = drawn.join(good, ["kind", "norm"], "left_anti").select("kind", "norm")
        if todo.isEmpty():
            return done
    # free for those who are left: an accepted surrogate is no entity of the corpus, and theirs of the first round is one
    last = F.when(F.col("kind").startswith("name_"), F.lit(MOST_ROUNDS)).otherwise(F.lit(0))
    return done.unionByName(todo.select("kind", "norm", _core(F.col("kind"), F.col("norm"), last, key).alias("core")))


def pseudonymise(docs: DataFrame, key: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, text, n_entities, kinds): texts with surrogates, and the kinds of entity found with their counts."""
    text = F.col(text_col)
    searched = keep(  # searched once; marked texts in place of the plain ones
        docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(id_col).cast("string"), F.lit("null")).alias("ik"), F.xxhash64(text).alias("th"), text.alias("text"), marked(_escaped(text)).alias("x")).select(
            "id", "ik", "th", F.coalesce("x.m", "text").alias("text"), "x.names", F.col("x.m").isNotNull().alias("has")
        )
    )
    names = learnt(searched)
    if names is not None:  # texts that a learnt word occurs in are searched again
        more = materialize(_beside(searched, names), "beside", compact=True)
        plain = F.when(F.col("has"), F.replace("text", F.lit(SEP), F.lit(""))).otherwise(_escaped(F.col("text")))
        again = searched.join(more, ["ik", "th"]).select("id", "ik", "th", marked(plain, F.col("more")).alias("x")).select("id", "ik", "th", F.col("x.m").alias("text"), "x.names", F.lit(True).alias("has"))
        searched = keep(searched.join(more, ["ik", "th"], "left_anti").select("id", "ik", "th", "text", "names", "has").unionByName(again))
    held = searched.where("has").withColumn("pieces", F.split("text", SEP, -1))
    found = held.select("ik", "th", "names", F.posexplode(F.filter("pieces", lambda p, i: i % 2 == 1)).alias("e", "entity"))
    tokens = materialize(_tokens(found), "tokens", compact=True)
    words = dictionary(tokens, key)
    told = (
        tokens.join(words, ["kind", "norm"], "left")
        .select("ik", "th", F.struct("e", "sub", "sep", "etype", F.coalesce(_dressed(F.col("kind"), F.col("original"), F.col("core")), F.col("original")).alias("s")).alias("p"))
        .groupBy("ik", "th")
        .agg(F.sort_array(F.collect_set("p")).alias("p"))
    )
    met = held.join(told, ["ik", "th"]).withColumn("gaps", F.filter("pieces", lambda x, i: i % 2 == 0))
    rebuilt = F.concat(
        F.array_join(F.transform("p", lambda p: F.concat(F.when(p["sub"] == 0, F.get("gaps", p["e"])).otherwise(""), p["s"], p["sep"])), ""),
        F.get("gaps", F.size("gaps") - 1),
    )
    heads = F.filter("p", lambda p: p["sub"] == 0)
    kinds = F.array_join(F.transform(F.array(*(F.lit(k) for k in PATTERNS)), lambda k: F.concat(k, F.lit(":"), F.size(F.filter(heads, lambda p: p["etype"] == k)).cast("string"))), ",")
    none = ",".join(f"{k}:0" for k in PATTERNS)
    changed = met.select(F.col("id").alias(id_col), F.replace(rebuilt, F.lit(ESCAPED), F.lit(_P)).alias(text_col), F.size(heads).cast("long").alias("n_entities"), kinds.alias("kinds"))
    plain = searched.where("not has").select(F.col("id").alias(id_col), F.col("text").alias(text_col), F.lit(0).cast("long").alias("n_entities"), F.lit(none).alias("kinds"))
    return changed.unionByName(plain)
