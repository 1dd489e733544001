"""Organisation numbers, their proofs in text, and other scalar functions, all as Columns."""

from __future__ import annotations

import sys
import unicodedata
from functools import cache

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Weights of the checksum; words that say nothing about a name; letters with a Latin spelling.
WEIGHTS = (3, 2, 7, 6, 5, 4, 3, 2)
LEGAL_WORDS = ("as", "asa", "ans", "da", "enk", "iks", "sa", "sam", "sti", "stiftelsen", "nuf", "ab", "b", "v", "limited", "ltd", "inc", "plc", "the", "og", "and")

#: Labelled numbers, then bare groups of nine digits.
LABELLED = r"(?i)(?:org(?:anisasjons)?\.?\s*(?:nr|nummer)?|foretaksregisteret|vat|mva|orgnr)[^0-9]{0,24}?(\d[\d\s. -]{7,15}\d)"
BARE = r"(?<!\d)(\d{3}[\s. ]?\d{3}[\s. ]?\d{3})(?!\d)"

#: The strength of each proof.
PROOFS = {"org_number_labelled_on_page": 1.0, "org_number_on_page": 0.97, "registry_site_corroborated": 0.93, "registry_declared_website": 0.80}


def digits(x: Column) -> Column:
    """Only the digits; null becomes the empty string."""
    return F.regexp_replace(F.coalesce(x.cast("string"), F.lit("")), r"\D", "")


def once(value: Column, then) -> Column:  # noqa: ANN001
    """then(value), with the value made once however often it is used."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


def check_remainder(base: Column) -> Column:
    """The weighted sum of the first eight digits, modulo 11."""
    return sum((F.substring(base, i + 1, 1).cast("int") * w for i, w in enumerate(WEIGHTS)), F.lit(0)) % 11


def is_valid(number: Column) -> Column:
    """Nine digits with a right check digit."""
    right = lambda d: once(check_remainder(d), lambda rest: (rest != 1) & (F.when(rest == 0, 0).otherwise(11 - rest) == F.substring(d, 9, 1).cast("int")))
    return once(digits(number), lambda d: F.when(F.length(d) != 9, False).otherwise(right(d)))


def shown(number: Column) -> Column:
    d = digits(number)
    return F.when(F.length(d) == 9, F.concat_ws(" ", F.substring(d, 1, 3), F.substring(d, 4, 3), F.substring(d, 7, 3))).otherwise(d)


_BETWEEN = "\x1f"


@cache
def _forms(form: str) -> tuple[str, str, str, str, str]:
    """Characters that a normal form of compatibility changes, by the rule of the standard.

    (singles, what each becomes; others, what each becomes with _BETWEEN between them, a pattern of the others).
    For NFKD only what is ASCII of it counts.
    """
    singles, single, others, several = [], [], [], []
    for n in range(0x80, sys.maxunicode + 1):
        c = chr(n)
        if 0xAC00 <= n < 0xD7A4 or 0xD800 <= n < 0xE000:  # syllables that fall into letters by rule, none of them ASCII; halves of characters
            continue
        to = unicodedata.normalize(form, c)
        if form == "NFKD":
            to = to.encode("ascii", "ignore").decode()
        if to == c or not to:
            continue
        if len(to) == 1:
            singles.append(c)
            single.append(to)
        else:
            others.append(c)
            several.append(to)
    ranges, points = [], [ord(c) for c in others]
    for n in points:
        if ranges and ranges[-1][1] == n - 1:
            ranges[-1][1] = n
        else:
            ranges.append([n, n])
    pattern = "[" + "".join(rf"\x{{{a:X}}}-\x{{{b:X}}}" for a, b in ranges) + "]"
    return "".join(singles), "".join(single), "".join(others), _BETWEEN.join(several), pattern


def _spelt(text: Column, form: str) -> Column:
    """The text with each character in its form; characters of their own are not put together."""
    singles, single, others, several, pattern = _forms(form)
    at = lambda c: F.call_function("instr", F.lit(others), c)
    one = lambda c: F.when(c.rlike(pattern), F.get(F.split(F.lit(several), _BETWEEN), at(c) - 1)).otherwise(c)
    plain = F.translate(text, singles, single)
    return F.when(text.rlike(pattern), F.array_join(F.transform(F.split(plain, ""), one), "")).otherwise(plain)


def flat(text: Column) -> Column:
    """Compatibility characters (wide, raised and ringed ones, ligatures, all kinds of blanks) as plain ones, so that patterns see them."""
    x = F.coalesce(text, F.lit(""))
    return F.when(x.rlike(r"[^\x00-\x7F]"), _spelt(x, "NFKC")).otherwise(x)


def proof(text: Column, expected: Column) -> Column:
    """The strongest proof that the text carries the expected number; empty if none."""
    t, want = flat(text), digits(expected)
    same = lambda x: digits(x) == want
    labelled = F.exists(F.regexp_extract_all(t, F.lit(LABELLED), F.lit(1)), same)
    bare = F.exists(F.regexp_extract_all(t, F.lit(BARE), F.lit(1)), same) & is_valid(want)
    return F.when(F.length(want) != 9, "").when(labelled, "org_number_labelled_on_page").when(bare, "org_number_on_page").otherwise("")


def span(text: Column, found: Column, pad: int = 45) -> Column:
    """The first occurrence of what was found with its surroundings, blanks collapsed; null if not found."""
    at = F.instr(text, found)
    cut = F.substring(text, F.greatest(at - pad, F.lit(1)), F.least(at - 1, F.lit(pad)) + F.length(found) + pad)
    return F.when((at > 0) & (found != ""), F.trim(F.regexp_replace(cut, r"\s+", " ")))


def conflicts(text: Column, expected: Column) -> Column:
    """Other valid numbers in the text, sorted."""
    t, want = flat(text), digits(expected)
    found = F.concat(*(F.transform(F.regexp_extract_all(t, F.lit(p), F.lit(1)), digits) for p in (LABELLED, BARE)))
    return F.array_sort(F.array_distinct(F.filter(found, lambda x: is_valid(x) & (x != want))))


def name_tokens(name: Column) -> Column:
    """Distinctive small tokens of a legal name; letters with marks lose them."""
    spelt = F.translate(F.coalesce(name, F.lit("")), "øØåÅ", "oOaA")
    spelt = F.lower(F.regexp_replace(F.regexp_replace(spelt, "æ", "ae"), "Æ", "AE"))
    marked = spelt.rlike(r"[^\x00-\x7F]")
    plain = F.lower(F.when(marked, F.regexp_replace(_spelt(spelt, "NFKD"), r"[^\x00-\x7F]+", "")).otherwise(spelt))
    return F.filter(F.regexp_extract_all(plain, F.lit("[a-z0-9]+"), F.lit(0)), lambda t: ~t.isin(*LEGAL_WORDS) & (F.length(t) > 1))


def proof_confidence(label: Column) -> Column:
    out = F.when(F.lit(False), 0.0)
    for k, v in PROOFS.items():
        out = out.when(label == k, v)
    return out.otherwise(0.0)


def employee_band(n: Column) -> Column:
    n = n.try_cast("long")
    return F.when(n.isNull(), "missing").when(n < 5, "1-4").when(n < 20, "5-19").when(n < 100, "20-99").otherwise("100+")


def or_else(*xs: Column) -> Column:
    """The first that is neither null nor empty."""
    return F.coalesce(*(F.when(x != "", x) for x in xs[:-1]), xs[-1])


def address(block: Column) -> Column:
    """Lines, postcode and place, and country of an address block; null if it has none."""
    lines = F.array_join(F.filter(F.coalesce(block["adresse"], F.array().cast("array<string>")), lambda x: x.isNotNull() & (x != "")), ", ")
    tail = F.array_join(F.filter(F.array(block["postnummer"], block["poststed"]), lambda x: x.isNotNull() & (x != "")), " ")
    every = F.array_join(F.filter(F.array(lines, tail, block["land"]), lambda x: x.isNotNull() & (x != "")), ", ")
    return F.when(every != "", every)


def site_url(raw: Column) -> Column:
    """A declared website with a scheme; placeholders are null."""
    x = F.trim(F.coalesce(raw, F.lit("")))
    return F.when(~F.lower(x).isin("", "-", "n/a", "ingen"), F.when(x.startswith("http://") | x.startswith("https://"), x).otherwise(F.concat(F.lit("https://"), x)))


def host(url: Column) -> Column:
    return F.regexp_replace(F.lower(F.coalesce(F.try_parse_url(url, F.lit("HOST")), F.lit(""))), r"^www\.", "")


def bare_url(url: Column) -> Column:
    """A url for comparison: no scheme, no www, no closing slash, one name for a renamed host."""
    x = F.regexp_replace(F.regexp_replace(F.lower(F.trim(F.coalesce(url, F.lit("")))), r"/+$", ""), r"^https?://(www\.)?", "")
    return F.regexp_replace(x, r"^twitter\.com", "x.com")


def money(value: Column, currency: Column) -> Column:
    unit, n = F.coalesce(F.when(currency != "", currency), F.lit("NOK")), F.abs(value)
    scaled = lambda by, word: F.concat(F.format_number(value / by, 1), F.lit(word))
    said = F.when(n >= 1e9, scaled(1e9, "bn")).when(n >= 1e6, scaled(1e6, "m")).when(n >= 1e3, scaled(1e3, "k")).otherwise(F.format_number(value, 0))
    return F.concat(unit, F.lit(" "), F.replace(said, F.lit(","), F.lit(" ")))


def titled(text: Column) -> Column:
    """Each run of letters with a capital first."""
    return F.array_join(F.transform(F.regexp_extract_all(text, F.lit(r"\p{L}+|\P{L}+"), F.lit(0)), lambda x: F.initcap(x)), "")


def seeded_rank(seed: str, key: Column) -> Column:
    """A stable pseudo-random order."""
    return F.sha2(F.concat(F.lit(f"{seed}:"), key.cast("string")), 256)


def nearest_rank(values: Column, percent: float) -> Column:
    """Percentile of a collected array: the value at the nearest rank, halves to even; 0 if there is none."""
    s = F.array_sort(values)
    n = F.size(s)
    at = F.bround(F.lit(percent / 100) * (n - 1), 0).cast("int")
    return F.when(n == 0, 0).otherwise(F.element_at(s, F.least(n - 1, at) + 1))
