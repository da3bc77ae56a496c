"""Personal data in texts, with DataFrame functions only.

Regular expressions propose spans; validators confirm them (Luhn for cards, mod-97 for account numbers,
ranges and digit counts for the rest); words nearby raise or lower a span's score. Spans of
the base kinds stay whatever their score; those of other kinds need ``LEAST_SCORE``.

The expressions are written so that Java's matcher neither recurses nor tries a long run again from
each of its characters: runs are possessive, and start only where no run goes on. They find what
their plain forms (``BASE``) find from left to right.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabprep.llm.shared import named

#: The base kinds in their order, in plain form (fixed patterns).
BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
_LOCAL = "[A-Za-z0-9._%+-]"
PATTERNS = {
    "email": rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}+",
    # Whole chains of 13 to 19 digits.
    "card": r"(?<![0-9])(?<![0-9][ -])[0-9](?:[ -]?[0-9]){12,18}+(?![ -]?[0-9])",
    "phone": BASE["phone"],
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
}
KINDS = list(PATTERNS)
_PART = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[0-9]{1,2})"
#: Score of a confirmed span, and words that raise or lower it.
SCORES = {"email": 0.9, "ip": 0.6, "card": 0.8, "phone": 0.6, "iban": 0.8, "ssn": 0.3}
FOR = {
    "email": "mail|contact|write",
    "ip": r"\bip\b|address|host|server|login",
    "card": "card|credit|visa|payment|karte|carte|tarjeta",
    "phone": r"phone|\btel|call|mobile|fax|telefon|llam",
    "iban": r"iban|account|bank|konto|compte|cuenta",
    "ssn": r"\bssn\b|social security",
}
AGAINST = r"version|isbn|\bdoi\b|serial|\bsku\b|part no"
CONTEXT = 40
CHUNK = 256  # code points of a part of a text
BLOCK = 64
RAISE, LOWER, LEAST_SCORE = 0.3, 0.3, 0.5


def _some(array: Column, first: Column, last: Column) -> Column:
    """Elements ``first`` to ``last`` of a column that is an array (an expression would be computed for each of them); a slice copies all of it first."""
    own = F.transform(F.sequence(first.cast("int"), last.cast("int")), lambda i: F.get(array, i))
    return F.when(last >= first, own).otherwise(F.array().cast("array<bigint>"))


class _Prefixes:
    """Sums, or greatest values, of the first elements of an array column of long integers, from those of its blocks and of blocks of blocks.

    A function over an array that gathers results in another one would copy that at each step.
    """

    def __init__(self, array: str, combine: Callable[[Column], Column]) -> None:
        self.levels, self.combine = [array, f"{array}_blocks", f"{array}_more"], combine

    def prepare(self, df: DataFrame) -> DataFrame:
        for own, above in zip(self.levels, self.levels[1:]):
            df = df.select("*", F.when(F.size(own) > 0, self._blocks(F.col(own))).alias(above))
        return df

    def _blocks(self, array: Column) -> Column:
        last = F.size(array) - 1
        numbers = F.sequence(F.lit(0), F.floor(last / BLOCK).cast("int"))
        return F.transform(numbers, lambda b: self.combine(_some(array, b * BLOCK, F.least(b * BLOCK + BLOCK - 1, last))))

    def up_to(self, i: Column) -> Column:
        """Of elements 0 to ``i``."""
        own, blocks, more = map(F.col, self.levels)
        b, m = F.floor(i / BLOCK), F.floor(i / BLOCK**2)
        parts = _some(more, F.lit(0), m - 1), _some(blocks, m * BLOCK, b - 1), _some(own, b * BLOCK, i)
        return self.combine(F.concat(*parts))


def _sum(array: Column) -> Column:
    return F.aggregate(array, F.lit(0).cast("bigint"), lambda a, b: a + b)


def _between(chunks: Column, begin: Column, end: Column) -> Column:
    """Code points ``begin`` to ``end`` of the text in ``chunks``, without going through what stands before them."""
    # Elements are got one by one: a slice copies the whole array first.
    own = F.transform(F.sequence(F.floor(begin / CHUNK).cast("int"), F.floor((end - 1) / CHUNK).cast("int")), lambda i: F.get(chunks, i))
    return F.when(end > begin, F.substr(F.array_join(own, ""), begin % CHUNK + 1, end - begin)).otherwise("")


def _luhn(digits: Column) -> Column:
    def add(total: Column, i: Column) -> Column:
        digit = F.substr(digits, -i, F.lit(1)).cast("int")
        return total + F.when(i % 2 == 1, digit).when(digit > 4, digit * 2 - 9).otherwise(digit * 2)

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), add) % 10 == 0


def _mod97(account: Column) -> Column:
    turned = F.concat(F.substr(account, F.lit(5)), F.substr(account, F.lit(1), F.lit(4)))

    def add(rest: Column, i: Column) -> Column:
        letter = F.ascii(F.substr(turned, i, F.lit(1)))
        return F.when(letter < 58, (rest * 10 + letter - 48) % 97).otherwise((rest * 100 + letter - 55) % 97)

    return F.aggregate(F.sequence(F.lit(1), F.length(turned)), F.lit(0), add) == 1


def _confirmed(kind: Column, value: Column) -> Column:
    return (
        F.when(kind == "ip", value.rlike(rf"^{_PART}(?:\.{_PART}){{3}}$"))
        .when(kind == "card", _luhn(F.regexp_replace(value, "[ -]", "")))
        .when(kind == "phone", F.length(F.regexp_replace(value, "[^0-9]", "")).between(9, 15))
        .when(kind == "iban", _mod97(F.regexp_replace(value, " ", "")))
        .otherwise(F.lit(True))
    )


def _by_kind(kind: Column, value: Callable[[str], Column]) -> Column:
    return F.coalesce(*[F.when(kind == k, value(k)) for k in KINDS])


def _once(value: Column) -> Column:
    """``value`` through a generator of one row, so that later filters on it don't compute it, and all it is made of, again."""
    return F.explode(F.array(value))


def _with_spans(df: DataFrame, text: str, out: str) -> DataFrame:
    """``df`` with an array of spans of the string column ``text``, in order of kind and start, and its parts, ``{out}_chunks``, if it has any.

    Helper columns have names that begin with ``out``. The work goes with the length of the text and the number of its matches.
    """
    names = [named(c) for c in df.columns]
    found = {k: f"{out}_{k}" for k in KINDS}
    chunks, matches, steps, size = (f"{out}_{x}" for x in ("chunks", "matches", "steps", "size"))
    df = df.select(*names, *[F.regexp_extract_all(F.col(text), F.lit(p), F.lit(0)).alias(found[k]) for k, p in PATTERNS.items()])

    def matches_of(kind: str) -> Column:
        # Each match with the length of the gap before it; after the last match comes one gap more, and without a match all is gap.
        def entry(gap: Column, value: Column) -> Column:
            return F.struct(F.lit(kind).alias("kind"), value.alias("value"), gap.cast("bigint").alias("gap"))

        split = F.zip_with(F.split(F.col(text), PATTERNS[kind], -1), F.col(found[kind]), lambda gap, value: entry(F.length(gap), value))
        return F.when(F.size(found[kind]) > 0, split).otherwise(F.array(entry(F.length(text), F.lit(None).cast("string"))))

    some = reduce(lambda a, b: a | b, [F.size(c) > 0 for c in found.values()])
    parts = F.regexp_extract_all(F.col(text), F.lit(f"(?s).{{1,{CHUNK}}}"), F.lit(0))
    df = df.select(*names, F.length(text).alias(size), *[F.when(some, c).alias(n) for c, n in ((parts, chunks), (F.concat(*map(matches_of, KINDS)), matches))])
    lengths = F.transform(F.col(matches), lambda m: m["gap"] + F.coalesce(F.length(m["value"]), F.lit(0)))
    sums = _Prefixes(steps, _sum)
    df = sums.prepare(df.select("*", lengths.alias(steps)))

    def placed(i: Column) -> Column:
        match = F.get(matches, i)
        # Gaps and matches of each kind add up to the text, and kinds follow each other.
        before = _by_kind(match["kind"], lambda k: F.lit(KINDS.index(k))) * F.col(size)
        end = (sums.up_to(i) - before).cast("int")
        return F.struct(match["kind"].alias("kind"), (end - F.length(match["value"])).alias("start"), end.alias("end"), match["value"].alias("value"))

    where = F.filter(F.sequence(F.lit(0), F.size(matches) - 1), lambda i: F.get(matches, i)["value"].isNotNull())
    good = F.filter(F.transform(where, placed), lambda x: _confirmed(x["kind"], x["value"]))

    def scored(x: Column) -> Column:
        before = _between(F.col(chunks), F.greatest(x["start"] - CONTEXT, F.lit(0)), x["start"])
        after = _between(F.col(chunks), x["end"], F.least(x["end"] + CONTEXT, F.col(size)))
        near = F.lower(F.concat(before, F.lit(" "), after))
        score = (
            _by_kind(x["kind"], lambda k: F.lit(SCORES[k]))
            + F.when(_by_kind(x["kind"], lambda k: near.rlike(FOR[k])), F.lit(RAISE)).otherwise(F.lit(0.0))
            - F.when(near.rlike(AGAINST), F.lit(LOWER)).otherwise(F.lit(0.0))
        )
        score = F.round(F.greatest(F.least(score, F.lit(1.0)), F.lit(0.0)), 2)
        return F.struct(x["kind"].alias("kind"), x["start"].alias("start"), x["end"].alias("end"), score.alias("score"))

    spans = F.filter(F.transform(good, scored), lambda x: x["kind"].isin(*BASE) | (x["score"] >= LEAST_SCORE))
    empty = F.array().cast("array<struct<kind:string,start:int,end:int,score:double>>")
    return df.select(*names, chunks, size, _once(F.when(F.col(matches).isNotNull(), spans).otherwise(empty)).alias(out))


def find_pii(docs: DataFrame, *, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id, spans``: an array of ``kind, start, end, score`` in code points (end exclusive), by kind and start.

    Null and empty texts have no spans; repeated rows and ids are judged row by row; an
    empty table gives no rows; other columns aren't read.
    """
    rows = docs.select(F.col(id_column).alias("doc_id"), F.coalesce(F.col(text_column).cast("string"), F.lit("")).alias("text"))
    return _with_spans(rows, "text", "spans").select("doc_id", "spans")


def redact(docs: DataFrame, *, text_column: str = "text") -> DataFrame:
    """``docs`` with all its columns and rows, and each span of personal data in the text, or run of overlapping ones, replaced by the ``<KIND>`` it begins with.

    Null texts stay null, texts without spans as they are; a long text with very many spans costs hardly more for each of them.
    """
    out = "__pii"
    while any(c.startswith(out) for c in docs.columns):
        out = f"_{out}"
    chunks, size, ordered, ends = (f"{out}_{x}" for x in ("chunks", "size", "ordered", "ends"))
    df = _with_spans(docs, text_column, out)
    names = [named(c) for c in docs.columns]
    by_start = F.array_sort(F.transform(F.col(out), lambda s: F.struct(s["start"].alias("start"), (-s["end"]).alias("back"), s["kind"].alias("kind"))))
    df = df.select(*names, chunks, size, F.when(F.size(out) > 0, by_start).alias(ordered))
    # How far each span and those before it reach.
    reach = _Prefixes(ends, F.array_max)
    df = reach.prepare(df.select("*", F.transform(F.col(ordered), lambda s: (-s["back"]).cast("bigint")).alias(ends)))

    def piece(i: Column) -> Column:
        span, at = F.get(ordered, i), F.when(i > 0, reach.up_to(i - 1).cast("int")).otherwise(0)
        tag = F.concat(F.lit("<"), F.upper(span["kind"]), F.lit(">"))
        return F.when(span["start"] >= at, F.concat(_between(F.col(chunks), at, span["start"]), tag)).otherwise("")

    last = F.size(ordered) - 1
    rest = _between(F.col(chunks), reach.up_to(last).cast("int"), F.col(size))
    text = F.when(F.size(ordered) > 0, F.concat(F.array_join(F.transform(F.sequence(F.lit(0), last), piece), ""), rest)).otherwise(F.col(text_column))
    return df.select(*[_once(text).alias(c) if c == text_column else named(c) for c in docs.columns])
