"""Personal data in texts: regular expressions propose, checksums confirm,
nearby words adjust the score. DataFrame functions only.

Every pattern is linear in the text: a token can only be tried from its first
character (look-behind, or the end of the previous match), and repeated groups
are possessive. A text is split once per kind into the pieces between matches
and the matches themselves; offsets are running sums over both, so a text is
never re-scanned per span.

Defined results: a NULL text counts as empty (no span); an empty text has no
span; rows are judged one by one, so repeated rows and repeated ids give
repeated results; columns other than the text are left alone.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Matches per block when offsets are summed (two-level prefix sums).
BLOCK = 256
# Characters of context looked at on each side of a match.
CONTEXT = 40


@dataclass(frozen=True)
class Rule:
    """One proposal: pattern, how it is confirmed, and how context scores it."""

    kind: str
    pattern: str
    hint: str | None          # cheap test a text must pass before the pattern runs
    base: bool                # always kept once confirmed; others need the threshold
    start: float = 1.0        # score before context
    context: str | None = None  # whole words nearby that raise the score
    check: str = "none"
    against: str | None = None  # whole words nearby that lower it, if none raises it


# Words beside a match that speak for a kind, or for some other number.
CARD_WORDS = ("cards?|visa|mastercard|master|credit|creditcard|karte|kreditkarte|kartennummer|carte|carte bleue|"
              "tarjeta")
PHONE_WORDS = ("phones?|tel|telephone|telefon|telefonnummer|telefono|teléfono|téléphone|calls?|call|calling|mobile|"
               "cell|handy|móvil|portable|fax|dial|whatsapp")
BANK_WORDS = "iban|banks?|bank account|accounts?|konto|bankkonto|kontonummer|compte|cuenta"
TAX_WORDS = "ssn|social security|tax id|taxpayer"
NUMBER_WORDS = "orders?|serial|tracking|sku|isbn|imei|versions?|build|code|ref|reference|ticket|part no|item|model"

# The patterns of the four listed kinds (made linear) and of the
# kinds that the method adds.
RULES = (
    Rule("email", r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
         "@", True),
    Rule("ip", r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}", None, True, check="ip"),
    Rule("card", r"[0-9](?:[\x20-]?[0-9])++", None, True, check="card"),
    Rule("phone", r"\+[0-9][\x20().0-9-]+[0-9]", "+", True, check="phone"),
    Rule("card", r"(?<![0-9])(?:[0-9]{4}[\x20-]?+){3}[0-9]{4}(?![0-9])", None, False, 0.7,
         CARD_WORDS, "luhn16", NUMBER_WORDS),
    Rule("phone", r"\+[0-9]{1,3}[\x20.-]?+(?:\([0-9]{1,4}\)|[0-9]{1,4})[\x20.-]?+[0-9]{2,4}[\x20.-]?+[0-9]{3,4}(?![0-9])",
         "+", False, 0.7, PHONE_WORDS, "phone", NUMBER_WORDS),
    Rule("iban", r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?+[A-Z0-9]{4}){2,7}(?:\x20?+[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
         None, False, 0.7, BANK_WORDS, "mod97", NUMBER_WORDS),
    Rule("ssn", r"(?<![0-9-])(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9-])",
         "-", False, 0.4, TAX_WORDS, against=NUMBER_WORDS),
    Rule("local_phone", r"(?<![0-9+().])\(?[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}(?![0-9])",
         None, False, 0.4, PHONE_WORDS, against=NUMBER_WORDS),
)
BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = ("email", "ip", "card", "phone", "iban", "ssn", "local_phone")
CONTEXT_BONUS = 0.3
# The added rules, strongest check first (check digits, length, words alone).
ADDED_ORDER = (6, 4, 5, 7, 8)
THRESHOLD = 0.6


def _digits(hit: Column) -> Column:
    return F.regexp_replace(hit, "[^0-9]", "")


def mod97(text: Column) -> Column:
    """Remainder by 97 of an account number, first four characters moved to the
    end and letters read as 10..35, digit by digit (any length)."""
    compact = F.regexp_replace(text, "[^A-Z0-9]", "")
    turned = F.concat(F.substring(compact, 5, 1 << 30), F.substring(compact, 1, 4))

    def step(acc: Column, ch: Column) -> Column:
        code = F.ascii(ch)
        letter = code >= 65
        return (acc * F.when(letter, 100).otherwise(10)
                + F.when(letter, code - 55).otherwise(code - 48)) % 97

    return F.aggregate(F.filter(F.split(turned, ""), lambda c: c != ""),
                       F.lit(0), step)


def _confirmed(rule: Rule, hit: Column) -> Column:
    d = _digits(hit)
    if rule.check == "ip":
        part = lambda p: F.length(F.regexp_replace(p, "^0+(?=.)", ""))
        value = lambda p: F.substring(F.concat(F.lit("00"), F.regexp_replace(p, "^0+(?=.)", "")), -3, 3)
        return F.forall(F.split(hit, r"\."), lambda p: (part(p) <= 3) & (value(p) <= "255"))
    if rule.check == "card":
        return F.length(d).between(16, 19) & F.call_function("luhn_check", d)
    if rule.check == "luhn16":
        return F.call_function("luhn_check", d)
    if rule.check == "phone":
        return F.length(d).between(8, 15)
    if rule.check == "mod97":
        return mod97(hit) == 1
    return F.lit(True)


def _possible(rule: Rule, text: Column, digits: Column) -> Column:
    ok = F.lit(True) if rule.kind == "email" else digits
    return ok & F.contains(text, F.lit(rule.hint)) if rule.hint else ok


def _blocks(gaps: Column, hits: Column) -> Column:
    """Lengths of each match and of the piece before it, in blocks of ``BLOCK``:
    sums run within blocks and over the blocks' totals, so that many matches
    in one text stay cheap."""
    lens = F.zip_with(F.slice(gaps, 1, F.size(hits)), hits,
                      lambda g, h: F.struct(g["len"].alias("g"), F.length(h).alias("h")))
    return F.transform(F.sequence(F.lit(0), F.floor((F.size(hits) - 1) / BLOCK).cast("int")),
                       lambda b: F.slice(lens, b * BLOCK + 1, F.lit(BLOCK)))


def _block_heads(blocks: Column) -> Column:
    totals = F.transform(blocks, lambda b: F.aggregate(
        b, F.lit(0), lambda acc, x: acc + x["g"] + x["h"]))
    return F.aggregate(totals, F.array(F.lit(0)),
                       lambda acc, t: F.array_append(acc, F.element_at(acc, -1) + t))


def _starts(blocks: Column, heads: Column) -> Column:
    def inside(block: Column, head: Column) -> Column:
        return F.aggregate(
            block, F.struct(head.alias("at"), F.expr("cast(array() as array<int>)").alias("out")),
            lambda acc, x: F.struct(
                (acc["at"] + x["g"] + x["h"]).alias("at"),
                F.array_append(acc["out"], acc["at"] + x["g"]).alias("out")))["out"]

    return F.flatten(F.zip_with(blocks, F.slice(heads, 1, F.size(blocks)), inside))


def _words(words: str) -> str:
    """Pattern of any of ``words`` that isn't a part of a longer word."""
    return rf"(?<![\p{{L}}\p{{N}}])(?:{words})(?![\p{{L}}\p{{N}}])"


def _score(rule: Rule, before: Column, after: Column) -> Column:
    """Start score, raised when a context word stands beside the match; lowered
    when none does but a word for another kind of number."""
    if not rule.context:
        return F.lit(rule.start)
    around = F.lower(F.concat_ws(" ", before, after))
    change = F.when(around.rlike(_words(rule.context)), CONTEXT_BONUS)
    if rule.against:
        change = change.when(around.rlike(_words(rule.against)), -CONTEXT_BONUS)
    return F.lit(rule.start) + change.otherwise(0.0)


def _before(gap: Column) -> Column:
    """The last ``CONTEXT`` characters of a piece; a word that is cut there is
    marked, so that its rest isn't taken for a whole word."""
    return F.when(F.length(gap) <= CONTEXT, gap).otherwise(
        F.regexp_replace(F.right(gap, F.lit(CONTEXT + 1)), r"^[\p{L}\p{N}]", "x"))


def _after(gap: Column) -> Column:
    """The first ``CONTEXT`` characters, marked likewise."""
    return F.when(F.length(gap) <= CONTEXT, gap).otherwise(
        F.regexp_replace(F.left(gap, F.lit(CONTEXT + 1)), r"[\p{L}\p{N}]$", "x"))


def _piece(rule: Rule) -> Callable[[Column], Column]:
    """Length of a piece between matches, with its ends where context counts."""
    def piece(g: Column) -> Column:
        before = _before(g) if rule.context else F.lit("")
        after = _after(g) if rule.context else F.lit("")
        return F.struct(F.length(g).alias("len"), before.alias("before"), after.alias("after"))

    return piece


def _scored(rule: Rule, gap: Column, hit: Column, start: Column) -> Callable[[Column], Column]:
    def scored(k: Column) -> Column:
        h, at = F.get(hit, k), F.get(start, k)
        score = _score(rule, F.get(gap, k)["before"], F.get(gap, k + 1)["after"])
        return F.struct(F.lit(rule.kind).alias("kind"), at.alias("start"),
                        (at + F.length(h)).alias("end"),
                        F.when(_confirmed(rule, h), F.least(score, F.lit(1.0)))
                        .otherwise(F.lit(0.0)).alias("score"))

    return scored


def _at_least(threshold: float) -> Callable[[Column], Column]:
    return lambda s: s["score"] >= threshold


def _replaced(rule: Rule, threshold: float) -> Callable[[Column, Column], Column]:
    """Piece before a match followed by its tag, or by the match where it isn't
    confirmed or scores too low."""
    tag = F.lit(f"[{rule.kind.upper()}]")

    def replaced(part: Column, after: Column) -> Column:
        ok = _confirmed(rule, part["hit"])
        if not rule.base:
            ok = ok & (_score(rule, _before(part["gap"]), _after(after)) >= threshold)
        return F.concat(part["gap"], F.when(ok, tag).otherwise(part["hit"]))

    return replaced


def find_spans(df: DataFrame, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """Add ``pii_base`` and ``pii_spans``: arrays of ``{kind, start, end, score}``
    (code points, end exclusive), ordered by kind as listed in ``KINDS``, then
    by start. ``pii_base`` has the confirmed matches of the four base patterns;
    ``pii_spans`` has those and what the other rules add: confirmed, scored at
    the threshold or more with the words around, and overlapping no base span nor
    another added one: of added spans that overlap, the kind with the stronger
    check stays (``ADDED_ORDER``).
    """
    work = df.withColumn("__text", F.coalesce(F.col(text), F.lit("")))
    work = work.withColumn("__digits", F.col("__text").rlike("[0-9]"))
    none = F.expr("cast(array() as array<string>)")
    no_gap = F.expr("cast(array() as array<struct<len:int,before:string,after:string>>)")
    stages: dict[str, Column] = {}
    for i, rule in enumerate(RULES):
        possible = _possible(rule, F.col("__text"), F.col("__digits"))
        stages[f"__h{i}"] = F.when(possible, F.regexp_extract_all(
            "__text", F.lit(rule.pattern), F.lit(0))).otherwise(none)
    work = work.withColumns(stages)
    pieces: dict[str, Column] = {}
    for i, rule in enumerate(RULES):
        pieces[f"__g{i}"] = F.when(F.size(f"__h{i}") > 0, F.transform(
            F.split("__text", rule.pattern, -1), _piece(rule))).otherwise(no_gap)
    work = work.withColumns(pieces)
    each = range(len(RULES))
    some = lambda i: F.size(f"__h{i}") > 0
    work = work.withColumns({f"__b{i}": F.when(some(i), _blocks(F.col(f"__g{i}"), F.col(f"__h{i}")))
                             for i in each})
    work = work.withColumns({f"__o{i}": F.when(some(i), _block_heads(F.col(f"__b{i}"))) for i in each})
    work = work.withColumns({f"__s{i}": F.when(some(i), _starts(F.col(f"__b{i}"), F.col(f"__o{i}")))
                             for i in each})
    spans: dict[str, Column] = {}
    empty = F.expr("cast(array() as array<struct<kind:string,start:int,end:int,score:double>>)")
    for i, rule in enumerate(RULES):
        gap, hit, start = F.col(f"__g{i}"), F.col(f"__h{i}"), F.col(f"__s{i}")
        spans[f"__p{i}"] = F.when(some(i), F.filter(
            F.transform(F.sequence(F.lit(0), F.size(hit) - 1), _scored(rule, gap, hit, start)),
            _at_least(0.01 if rule.base else threshold))).otherwise(empty)
    helpers = [c for i in each for c in (f"__h{i}", f"__g{i}", f"__b{i}", f"__o{i}", f"__s{i}")]
    work = work.withColumns(spans).drop(*helpers, "__text", "__digits")
    base = [i for i in each if RULES[i].base]
    work = work.withColumn("pii_base", F.concat(*[F.col(f"__p{i}") for i in base]))
    work = work.withColumn("__taken", F.col("pii_base"))
    for i in ADDED_ORDER:
        work = work.withColumn(f"__x{i}", F.when(F.size(f"__p{i}") == 0, empty).otherwise(
            F.filter(f"__p{i}", lambda s: ~F.exists("__taken", lambda b: (b["start"] < s["end"])
                                                    & (s["start"] < b["end"])))))
        if i != ADDED_ORDER[-1]:
            work = work.withColumn("__taken", F.when(F.size(f"__x{i}") == 0, F.col("__taken")).otherwise(
                F.concat("__taken", f"__x{i}")))
    by_kind = []
    for kind in KINDS:
        parts = [F.col(f"__p{i}" if RULES[i].base else f"__x{i}") for i in each if RULES[i].kind == kind]
        by_kind.append(parts[0] if len(parts) == 1 else F.array_sort(
            F.concat(*parts), lambda a, b: a["start"] - b["start"]))
    return work.withColumn("pii_spans", F.concat(*by_kind)).drop(
        "__taken", *[f"__p{i}" for i in each], *[f"__x{i}" for i in ADDED_ORDER])


def spans_text(spans: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


# Which rules redact, in which order: long forms first, phones once more at the
# end because a number may have hidden another until it was replaced.
REDACTION = (0, 4, 2, 6, 3, 5, 1, 3, 5, 7, 8)


def redact(df: DataFrame, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """Replace confirmed personal data in ``text`` by ``[KIND]``.

    Rules run one after another, each on what the ones before left, so data
    that another match covered or ran into is found as well. A NULL text stays
    NULL; a text without personal data stays as it is.
    """
    out = df.withColumn("__digits", F.col(text).rlike("[0-9]"))
    for step, i in enumerate(REDACTION):
        rule = RULES[i]
        hits, new = f"__h{step}", f"__t{step}"
        source = F.col(text if step == 0 else f"__t{step - 1}")
        out = out.withColumn(hits, F.when(_possible(rule, source, F.col("__digits")),
                                          F.regexp_extract_all(source, F.lit(rule.pattern), F.lit(0))))
        source = F.col(text if step == 0 else f"__t{step - 1}")
        out = out.withColumn("__g", F.when(F.size(hits) > 0, F.split(source, rule.pattern, -1)))
        after = F.slice(F.col("__g"), 2, F.size(hits))
        joined = F.concat(
            F.array_join(F.zip_with(
                F.arrays_zip(F.slice(F.col("__g"), 1, F.size(hits)).alias("gap"), F.col(hits).alias("hit")),
                after, _replaced(rule, threshold)), ""),
            F.element_at("__g", -1))
        out = out.withColumn(new, F.when(F.size(hits) > 0, joined).otherwise(source))
        out = out.drop("__g", hits, *([f"__t{step - 1}"] if step else []))
    last = f"__t{len(REDACTION) - 1}"
    return out.withColumn(text, F.col(last)).drop(last, "__digits")
