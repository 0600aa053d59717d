"""Personal data: regular expressions propose, checksums confirm, context words adjust.

DataFrame functions only, one map over the rows.  A pattern's matches come
from regexp_extract_all and the text between them from a split by the same
pattern; running sums of both lengths, chunk by chunk, give the code-point offsets,
and the neighbouring pieces are the context.  Patterns use possessive quantifiers,
so no text makes them backtrack over a run again and again, and no array grows
match by match, so a text that is one long list of matches takes time in
proportion to its length.

Context words count as whole words (with a plural ending); words that speak for the
kind raise a match's score and words that speak against it lower it.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ident, let

BEFORE, AFTER = 40, 20           # code points of context looked at on either side
CHUNK = 32                       # matches whose offsets are summed up in one array


@dataclass(frozen=True)
class Kind:
    name: str
    pattern: str                 # Java regular expression; matches are leftmost and do not overlap
    hint: str                    # a text without this cannot match (a cheap test), "" for none
    valid: Callable[[Column], Column]
    words: str                   # context words that speak for the kind, as an alternation
    against: str                 # and those that speak against it
    start: float                 # score of a bare match
    checked: float               # added when the validator is a real check
    base: bool = True            # kept whatever its score


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def _digit(text: Column, at: Column) -> Column:
    return F.ascii(F.substring(text, at, F.lit(1))) - 48


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""
    n = F.length(digits)

    def one(i: Column) -> Column:
        d = _digit(digits, n - i)
        twice = F.when(d > 4, d * 2 - 9).otherwise(d * 2)
        return F.when(i % 2 == 1, twice).otherwise(d)

    total = F.aggregate(F.transform(F.sequence(F.lit(0), n - 1), one), F.lit(0), lambda a, x: a + x)
    return total % 10 == 0


def mod97(iban: Column) -> Column:
    """Whether an account number without spaces passes the mod-97 check."""
    moved = F.concat(F.substring(iban, 5, 64), F.substring(iban, 1, 4))

    def step(a: Column, i: Column) -> Column:
        c = F.ascii(F.substring(moved, i, F.lit(1)))
        return F.when(c < 58, (a * 10 + c - 48) % 97).otherwise((a * 100 + c - 55) % 97)

    return F.aggregate(F.sequence(F.lit(1), F.length(moved)), F.lit(0), step) == 1


def _always(m: Column) -> Column:
    return F.lit(True)


def _ip(m: Column) -> Column:
    def small(p: Column) -> Column:
        bare = F.regexp_replace(p, "^0+", "")
        return (F.length(bare) < 3) | ((F.length(bare) == 3) & (bare <= F.lit("255")))
    return F.forall(F.split(m, r"\."), small)


def _card(m: Column) -> Column:
    d = _digits(m)
    return F.when(F.length(d).between(16, 19), luhn(d)).otherwise(False)


def _phone(m: Column) -> Column:
    return F.length(_digits(m)).between(8, 15)


def _iban(m: Column) -> Column:
    bare = F.replace(m, F.lit(" "), F.lit(""))
    return F.when(F.length(bare).between(15, 34), mod97(bare)).otherwise(False)


def _ssn(m: Column) -> Column:
    return ~m.rlike(r"^(?:000|666|9..)|-00-|-0000$")


# The first four patterns and limits are the contract's; an atom
# that may start only at the head of a run (or right after a match) finds the
# same matches without trying every later position of the run.
_LOCAL = "A-Za-z0-9._%+-"
KINDS = (
    Kind("email", rf"(?:(?<![{_LOCAL}])|\G)[{_LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", "@", _always,
         "mail|e-?mail|contact|write|kontakt|correo|courriel", "example|sample|beispiel|ejemplo|exemple", 0.7, 0.0),
    Kind("ip", r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", ".", _ip,
         "ip|host|server|address|adresse|login", "version|release|section|chapter|kapitel|versión", 0.5, 0.2),
    Kind("card", r"[0-9](?:[\x20-]?[0-9])++", "", _card,
         "card|credit|visa|mastercard|pay|payment|karte|kreditkarte|tarjeta|carte", "isbn|serial|tracking|order|invoice", 0.4, 0.4),
    Kind("phone", r"\+[0-9][\x20().0-9-]+[0-9]", "+", _phone,
         "phone|telephone|telefon|tel|call|mobile|fax|anruf|llama|appel", "isbn|serial|tracking|order|invoice", 0.5, 0.1),
    Kind("iban", r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}+(?![A-Za-z0-9])", "", _iban,
         "iban|bank|account|konto|cuenta|compte", "serial|tracking|model|part", 0.4, 0.4, base=False),
    Kind("ssn", r"(?<![0-9A-Za-z-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9A-Za-z-])", "-", _ssn,
         "ssn|social|security|insurance|versicherung|seguro", "serial|tracking|part|phone|fax", 0.3, 0.1, base=False),
)


def _word(text: Column, words: str) -> Column:
    return text.rlike(rf"(?<![\p{{L}}\p{{N}}])(?:{words})(?:s|n|en)?(?![\p{{L}}\p{{N}}])")


def _spots(match: Column, gaps: Column) -> Column:
    """array<struct<start,end,m,around>> of the matches and the one more gaps around them."""
    spot = "array<struct<start:bigint,end:bigint,m:string,around:string>>"

    def step(a: Column, p: Column) -> Column:
        start = a["at"] + F.length(p["g"])
        end = start + F.length(p["m"])
        around = F.concat_ws(" ", F.right(p["g"], F.lit(BEFORE)), F.left(p["next"], F.lit(AFTER)))
        one = F.struct(start.alias("start"), end.alias("end"), p["m"].alias("m"), around.alias("around"))
        return F.struct(end.alias("at"), F.concat(a["out"], F.array(one)).alias("out"))

    def paired(z: Column) -> Column:
        parts = F.zip_with(z["match"], z["gaps"], lambda m, g: F.struct(m.alias("m"), g.alias("g")))
        after = F.slice(z["gaps"], F.lit(2), F.size(z["gaps"]))
        parts = F.zip_with(parts, after, lambda p, g: F.struct(p["m"].alias("m"), p["g"].alias("g"), g.alias("next")))
        return F.filter(parts, lambda p: p["m"].isNotNull())

    def chunked(parts: Column) -> Column:
        each = F.sequence(F.lit(0), F.greatest(F.ceil(F.size(parts) / CHUNK).cast("int") - 1, F.lit(0)))
        return F.transform(each, lambda c: F.slice(parts, c * CHUNK + 1, F.lit(CHUNK)))

    def measured(chunks: Column) -> Column:
        long = F.transform(chunks, lambda ch: F.aggregate(ch, F.lit(0).cast("bigint"), lambda a, p: a + F.length(p["g"]) + F.length(p["m"])))
        return F.struct(chunks.alias("chunks"), long.alias("long"))

    def placed(z: Column) -> Column:
        def one(ch: Column, c: Column) -> Column:
            at = F.aggregate(F.slice(z["long"], F.lit(1), c), F.lit(0).cast("bigint"), lambda a, x: a + x)
            return F.aggregate(ch, F.struct(at.alias("at"), F.array().cast(spot).alias("out")), step, lambda a: a["out"])
        return F.flatten(F.transform(z["chunks"], one))

    return let(let(let(let(F.struct(match.alias("match"), gaps.alias("gaps")), paired), chunked), measured), placed)


def _found(text: Column, k: Kind) -> Column:
    """array<struct<kind,start,end,score,match>> of one kind, valid matches only."""
    spots = _spots(F.regexp_extract_all(text, F.lit(k.pattern), F.lit(0)), F.split(text, k.pattern, -1))

    def scored(s: Column) -> Column:
        near = F.lower(s["around"])
        score = F.lit(k.start + k.checked) + F.when(_word(near, k.words), 0.2).otherwise(0.0) - F.when(_word(near, k.against), 0.2).otherwise(0.0)
        return F.struct(F.lit(k.name).alias("kind"), s["start"].alias("start"), s["end"].alias("end"),
                        F.round(F.greatest(F.lit(0.0), F.least(F.lit(1.0), score)), 2).alias("score"), s["m"].alias("match"))

    some = text.rlike(k.pattern)
    if k.hint:
        some = F.contains(text, F.lit(k.hint)) & some
    none = F.array().cast("array<struct<kind:string,start:bigint,end:bigint,score:double,match:string>>")
    return F.when(some, F.transform(F.filter(spots, lambda s: k.valid(s["m"])), scored)).otherwise(none)


def scan(docs: DataFrame, text: str = "text", out: str = "spans", min_score: float = 0.6) -> DataFrame:
    """All columns of ``docs`` plus ``out``: array<struct<kind,start,end,score,match>>
    ordered by kind as in KINDS, then start; offsets in code points, end exclusive.

    Matches of a kind that fail its validator are dropped.  Kinds beyond the
    base ones need ``min_score``, so an unchecked pattern counts only near its
    context words.  A null text is empty and has no span; the number of spans
    is not limited.  Repeated rows stay; a column named ``out`` is replaced.
    """
    t = F.coalesce(ident(text), F.lit(""))
    found = [_found(t, k) if k.base else F.filter(_found(t, k), lambda s: s["score"] >= min_score) for k in KINDS]
    return docs.withColumn(out, F.concat(*found))


def summary(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_extra, top_score."""
    d = scan(docs.select(ident(doc_id).alias("doc_id"), ident(text).alias("text")), out="found").drop("text")
    base = [k.name for k in KINDS if k.base]

    def shown(a: Column) -> Column:
        return F.array_join(F.transform(a, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def count(kind: str) -> Column:
        return F.size(F.filter("found", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    own = F.filter("found", lambda s: s["kind"].isin(base))
    return d.select("doc_id", *(count(k) for k in base), F.sha2(shown(own), 256).alias("base_sha256"),
                    shown(F.col("found")).alias("spans"), (F.size("found") - F.size(own)).cast("long").alias("n_extra"),
                    F.array_max(F.transform("found", lambda s: s["score"])).alias("top_score"))
