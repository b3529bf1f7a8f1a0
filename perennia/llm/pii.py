"""Personal data in texts: exact base patterns, and further spans by weak supervision.

DataFrame functions only. A native regular expression gives the matches and what lies between them
(`regexp_extract_all` and `split`); running sums of their lengths give the places. The patterns
are written so that no run of characters is scanned twice or recursed into, however long.

Further spans are words with a digit or `@`; of words that are long or that base spans meet, parts. Five labelers vote on each (1 personal, 0 not, x abstain):
shape by regular expression, a gazetteer of names for secrets, the words before it, its form, and
whether a base span covers it. The counts of the votes over the whole corpus - a table of at most
3^5 votes times the forms - go to the driver, where expectation-maximisation estimates how
reliable each labeler is and, with the posterior as soft labels, a naive Bayes classifier over the
forms is fitted. Every candidate is then judged by that classifier, in a second scan.
"""

from __future__ import annotations

import math
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from perennia.llm.common import between, blocks_of, filled, let, running_maxima, running_sums, unused

#: Possessive, and anchored where a run begins (or the last match ended): same matches, linear time.
EMAIL = r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
#: A word with a digit or `@`.
CANDIDATE = r"(?<![^\x20\x09-\x0D])[^\x20\x09-\x0D0-9@]*+[0-9@][^\x20\x09-\x0D]*+"
KINDS = ("email", "ip", "card", "phone")
OTHER = "other"

GAZETTEER = r"(?i)(akia|passw|secret|token|api_?key|iban|ssn)"
CUES = r"(?i)(passw(or)?d|token|secret|key|phone|tel|call|mobile|card|account|iban|ssn|contact|mail)[^A-Za-z0-9]{0,4}$"
NO_CUES = r"(?i)(version|licen[sc]e|chapter|page|section|by-nc|by-sa)[^A-Za-z0-9]{0,3}$"
SHAPES = (
    r"AKIA[0-9A-Z]{16}|=[0-9A-Za-z]{8,}|[0-9a-f]{18,}"
    r"|\(?[0-9]{3}\)?[.-][0-9]{3}[.-][0-9]{4}|\b[0-9]{3}-[0-9]{2}-[0-9]{4}\b|\b[A-Z]{2}[0-9]{2}[A-Z0-9]{11,30}\b"
)
NO_SHAPES = r"^[^0-9]*[0-9]{1,4}[^0-9]*$|^[0-9]+(\.[0-9]+){1,2}[.,;]?$"
CONTEXT = 24
#: Words longer than this, and what base spans leave of a word, are judged by their parts.
SEEN = 256
#: A part: a shape, or what lies between shapes, punctuation and other scripts, in pieces of at most SEEN characters.
PART = (
    rf"(?:{SHAPES})"
    rf"|(?:(?!{SHAPES})[\x21-\x7E&&[^&;,?\"'{{}}()\[\]<>|=:]]){{1,{SEEN}}}+"
    rf"|[^\x00-\x7F]{{1,{SEEN}}}+"
)


class SpanModel(NamedTuple):
    """Log odds: of a span at all, and by form. `reliability` holds P(vote | class) by labeler."""

    prior: float
    forms: dict[str, float]
    reliability: list[dict[tuple[str, int], float]]


def _matches(text: Column, pattern: str) -> Column:
    """Array of (text, before, start) of the leftmost non-overlapping matches; `before` is the gap."""

    def with_gaps(found):
        gaps = F.slice(F.split(text, pattern, -1), F.lit(1), F.size(found))
        return F.zip_with(found, gaps, lambda m, gap: F.struct(m.alias("text"), gap.alias("before")))

    def placed(pairs):
        lengths = F.transform(pairs, lambda p: (F.char_length(p["text"]) + F.char_length(p["before"])).cast("long"))
        return F.zip_with(
            pairs,
            running_sums(lengths),
            lambda p, s: F.struct(
                p["text"].alias("text"), p["before"].alias("before"), (s + F.char_length(p["before"])).alias("start")
            ),
        )

    return let(let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), with_gaps), placed)


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """Whether the check digit is right."""
    last = F.char_length(digits)

    def value(i):
        d = F.substring(digits, i, F.lit(1)).cast("int")
        twice = F.when(d > 4, d * 2 - 9).otherwise(d * 2)
        return F.when((last - i) % 2 == 1, twice).otherwise(d)

    total = F.aggregate(F.transform(F.sequence(F.lit(1), last), value), F.lit(0), lambda acc, x: acc + x)
    return total % 10 == 0


def _valid(kind: str, text: Column) -> Column:
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        return F.forall(F.split(text, r"\."), lambda part: part.cast("double") <= 255)
    if kind == "phone":
        return F.char_length(_digits(text)).between(9, 15)
    return let(
        _digits(text),
        lambda digits: F.when(F.char_length(digits).between(13, 19), _luhn(digits)).otherwise(F.lit(False)),
    )


def _span(kind: str, match: Column) -> Column:
    return F.struct(
        F.lit(kind).alias("kind"),
        match["start"].alias("start"),
        (match["start"] + F.char_length(match["text"])).alias("end"),
    )


_SPANS = "array<struct<kind:string,start:bigint,end:bigint>>"


def _base(text: Column) -> Column:
    """All base spans, by kind as listed, then start. The cheap tests spare most texts the search."""
    may = {
        "email": F.contains(text, F.lit("@")),
        "ip": text.rlike(r"[0-9]\.[0-9]"),
        "card": text.rlike(r"[0-9](?:[\x20-]?[0-9]){12}"),
        "phone": F.contains(text, F.lit("+")),
    }
    patterns = dict(zip(KINDS, (EMAIL, IP, CARD, PHONE)))

    def found(kind):
        valid = F.filter(_matches(text, patterns[kind]), lambda m: _valid(kind, m["text"]))
        return F.when(may[kind], F.transform(valid, lambda m: _span(kind, m))).otherwise(F.array().cast(_SPANS))

    return F.concat(*[found(kind) for kind in KINDS])


def _vote(yes: Column, no: Column) -> Column:
    return F.when(yes, "1").when(no, "0").otherwise("x")


def _merged(spans: Column) -> Column:
    """Disjoint (start, end, kind) in order: each span that begins where none before it runs, as far as those that overlap it."""

    def heads(ordered):
        before = running_maxima(F.transform(ordered, lambda s: s["end"]))
        paired = F.zip_with(ordered, before, lambda s, b: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), b.alias("before")))
        longest = F.array_max(F.transform(ordered, lambda s: s["end"]))

        def ended(found):
            return F.transform(
                found,
                lambda s, i: F.struct(
                    s["start"].alias("start"),
                    F.coalesce(F.get(found, i + 1)["before"], longest).alias("end"),
                    s["kind"].alias("kind"),
                ),
            )

        return let(F.filter(paired, lambda s: s["start"] >= s["before"]), ended)

    ordered = F.array_sort(
        F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind")))
    )
    return let(ordered, heads)


def _steps(spans: Column) -> Column:
    """The steps of a binary search over `spans`, the widest first."""
    widest = F.floor(F.log2(F.size(spans) + 1)).cast("int")
    return F.transform(F.sequence(widest, F.lit(0)), lambda i: F.call_function("shiftleft", F.lit(1), i))


def _overlapping(merged: Column, steps: Column, start: Column, end: Column) -> Column:
    """Those of the disjoint spans that reach into the place from `start` to `end`, by binary search for both ends."""

    def count(holds):
        return F.aggregate(
            steps,
            F.lit(0),
            lambda at, step: F.when(
                (at + step <= F.size(merged)) & holds(F.get(merged, at + step - 1)), at + step
            ).otherwise(at),
        )

    return let(
        F.struct(count(lambda s: s["end"] <= start).alias("low"), count(lambda s: s["start"] < end).alias("high")),
        lambda found: F.slice(merged, found["low"] + 1, found["high"] - found["low"]),
    )


def _gaps(word: Column, end: Column, spans: Column) -> Column:
    """Array of (start, end), places in the text, of what disjoint spans in order leave of a word."""
    gaps = F.transform(
        F.sequence(F.lit(0), F.size(spans)),
        lambda i: F.struct(
            F.greatest(word["start"], F.get(spans, i - 1)["end"]).alias("start"),
            F.least(end, F.get(spans, i)["start"]).alias("end"),
        ),
    )
    return F.filter(gaps, lambda gap: gap["start"] < gap["end"])


def _parts(word: Column, end: Column, spans: Column) -> Column:
    """The parts of a word, outside the base spans in it, that are candidates; each with its votes and form."""

    def of_gap(gap, blocks):
        text = between(blocks, gap["start"] - word["start"], gap["end"] - word["start"])
        # What stands before the first part of a word is what stands before the word.
        lead = F.when(gap["start"] == word["start"], word["before"]).otherwise("")

        def placed(parts):
            return F.transform(
                parts,
                lambda p, i: F.struct(
                    p["text"].alias("text"),
                    F.concat(F.when(i == 0, lead).otherwise(F.get(parts, i - 1)["text"]), p["before"]).alias("before"),
                    (gap["start"] + p["start"]).alias("start"),
                ),
            )

        return let(_matches(text, PART), placed)

    def may(part):
        # With a digit or `@` as words are, or told by its shape or by the words before it.
        return part["text"].rlike("[0-9@]") | part["text"].rlike(SHAPES) | part["before"].rlike(CUES)

    parts = let(
        blocks_of(word["text"]),
        lambda blocks: F.flatten(F.transform(_gaps(word, end, spans), lambda gap: of_gap(gap, blocks))),
    )
    return F.transform(F.filter(parts, may), lambda p: _voted(p, F.lit(False)))


def _judged(word: Column, merged: Column, steps: Column) -> Column:
    """The candidates in a word with their votes and forms: itself, or its parts if it is long or base spans meet it."""
    end = word["start"] + F.char_length(word["text"])
    short = F.char_length(word["text"]) <= SEEN

    def judged(spans):
        covered = F.size(spans) > 0
        whole = F.when(short, F.array(_voted(word, covered))).otherwise(F.array())
        return F.concat(whole, F.when(short & ~covered, F.array()).otherwise(_parts(word, end, spans)))

    return let(_overlapping(merged, steps, word["start"], end), judged)


def _voted(candidate: Column, covered: Column) -> Column:
    return let(
        F.struct(
            candidate["text"].alias("seen"), F.substring(candidate["before"], -CONTEXT, CONTEXT).alias("before")
        ),
        lambda parts: _ballot(candidate, parts["seen"], parts["before"], covered),
    )


def _ballot(candidate: Column, seen: Column, before: Column, covered: Column) -> Column:
    end = candidate["start"] + F.char_length(seen)
    length = F.char_length(seen)
    digits = F.char_length(_digits(seen))
    letters = F.char_length(F.regexp_replace(seen, "[^A-Za-z]", ""))
    votes = F.concat(
        _vote(seen.rlike(SHAPES), seen.rlike(NO_SHAPES)),
        _vote(seen.rlike(GAZETTEER), F.lit(False)),
        _vote(before.rlike(CUES), before.rlike(NO_CUES)),
        _vote((length >= 12) & (digits >= 3), length <= 4),
        _vote(covered, F.lit(False)),
    )
    form = F.concat_ws(
        " ",
        F.concat(F.lit("length"), F.least(F.floor(F.log2(length)), F.lit(6)).cast("string")),
        F.concat(F.lit("digits"), F.round(F.try_divide(digits * 4, length)).cast("int").cast("string")),
        F.concat(F.lit("letters"), F.round(F.try_divide(letters * 4, length)).cast("int").cast("string")),
        F.when(seen.rlike("[=@]"), "sign").otherwise("plain"),
        F.when(seen.rlike("[A-Z]"), "upper").otherwise("lower"),
        F.when(before.rlike(r"[=:]\x20?[\"']?$"), "assigned").otherwise("free"),
    )
    return F.struct(
        candidate["start"].alias("start"), end.alias("end"), covered.alias("covered"), votes.alias("votes"), form.alias("form")
    )


def _candidates(docs: DataFrame, text_col: str) -> tuple[DataFrame, str, str]:
    """`docs` with two more columns, and their names: the base spans, and the candidates (null: none)."""
    base = unused("base", docs)
    with_base = docs.withColumn(base, _base(filled(F.col(text_col))))
    found = unused("found", with_base)
    text = filled(F.col(text_col))

    def judged(spans):
        merged, steps = spans["merged"], spans["steps"]
        return F.flatten(F.transform(_matches(text, CANDIDATE), lambda word: _judged(word, merged, steps)))

    def searched(merged):
        return let(F.struct(merged.alias("merged"), _steps(merged).alias("steps")), judged)

    candidates = F.when(text.rlike("[0-9@]"), let(_merged(F.col(base)), searched))
    return with_base.withColumn(found, candidates), base, found


def fit(counts: list[tuple[str, str, int]], rounds: int = 50) -> SpanModel:
    """EM over (votes, form, number of candidates), then naive Bayes over the words of the forms."""
    votes: dict[str, float] = {}
    for v, _, n in counts:
        votes[v] = votes.get(v, 0.0) + n
    total, labelers = sum(votes.values()), len(next(iter(votes), ""))
    # A labeler starts out as right more often than not; x says little either way.
    start = {("1", 1): 0.4, ("0", 1): 0.1, ("x", 1): 0.5, ("1", 0): 0.1, ("0", 0): 0.4, ("x", 0): 0.5}
    reliability, share = [dict(start) for _ in range(labelers)], 0.5
    posterior: dict[str, float] = {}
    for _ in range(rounds):
        for v in votes:
            p = [1 - share, share]
            for i, vote in enumerate(v):
                p = [p[c] * reliability[i][vote, c] for c in (0, 1)]
            posterior[v] = p[1] / (p[0] + p[1])
        weight = [sum(n * (1 - posterior[v]) for v, n in votes.items()), sum(n * posterior[v] for v, n in votes.items())]
        share = (weight[1] + 1) / (total + 2)
        for i in range(labelers):
            for c in (0, 1):
                for vote in "10x":
                    n = sum(n * (posterior[v] if c else 1 - posterior[v]) for v, n in votes.items() if v[i] == vote)
                    # The start counts as ten candidates, so that the classes keep their meaning.
                    reliability[i][vote, c] = (n + 10 * start[vote, c]) / (weight[c] + 10)
    by_word: dict[str, list[float]] = {}
    for v, form, n in counts:
        for word in form.split(" "):
            seen = by_word.setdefault(word, [0.0, 0.0])
            seen[0] += n * (1 - posterior[v])
            seen[1] += n * posterior[v]
    odds = {
        word: math.log((yes + 0.5) / (weight[1] + 1)) - math.log((no + 0.5) / (weight[0] + 1))
        for word, (no, yes) in by_word.items()
    } if votes else {}
    return SpanModel(math.log(share / (1 - share)), odds, reliability)


def learn_spans(docs: DataFrame, text_col: str = "text") -> SpanModel:
    """The model of this corpus, from the votes on all candidates of all texts."""
    rows, _, found = _candidates(docs.select(text_col), text_col)
    counts = rows.select(F.explode(found).alias("c")).groupBy("c.votes", "c.form").count().collect()
    return fit(sorted((r["votes"], r["form"], r["count"]) for r in counts))


def annotate(docs: DataFrame, model: SpanModel, text_col: str = "text") -> DataFrame:
    """`docs` with `base_spans` and `spans`, arrays of (kind, start, end) in code points, end exclusive.

    Both are sorted by kind as in KINDS (OTHER last), then start. `spans` holds the base spans and
    each candidate that the model takes for personal data. A word that base spans meet, or of more
    than SEEN characters, is judged by its parts outside them, each with its own place. Null and
    empty texts have none, repeated rows the same each, an empty table stays empty. Columns of these two names are
    replaced; all others stay as they are, whatever their names. Time is near the length of a text and its spans.
    """
    rows, base, found = _candidates(docs, text_col)
    if model.forms:
        odds = F.create_map(*[F.lit(x) for word, weight in sorted(model.forms.items()) for x in (word, weight)])
        score = lambda c: F.aggregate(
            F.split(c["form"], " "),
            F.lit(model.prior),
            lambda acc, word: acc + F.coalesce(F.try_element_at(odds, word), F.lit(0.0)),
        )
        more = F.transform(
            F.filter(F.coalesce(found, F.array()), lambda c: ~c["covered"] & (score(c) > 0)),
            lambda c: F.struct(F.lit(OTHER).alias("kind"), c["start"].alias("start"), c["end"].alias("end")),
        )
    else:
        more = F.array().cast(_SPANS)
    kept = [F.col("`" + c.replace("`", "``") + "`") for c in docs.columns if c.lower() not in ("base_spans", "spans")]
    return rows.select(*kept, F.col(base).alias("base_spans"), F.concat(base, more).alias("spans"))


def redact(text: Column, spans: Column) -> Column:
    """The text with each span replaced by its kind in angle brackets; of overlapping ones the first counts."""

    def replaced(found):
        def whole(parts):
            merged, blocks = parts["merged"], parts["blocks"]
            zero = F.lit(0).cast("long")
            marked = F.transform(
                merged,
                lambda s, i: F.concat(
                    between(blocks, F.coalesce(F.get(merged, i - 1)["end"], zero), s["start"]), F.lit("<"), s["kind"], F.lit(">")
                ),
            )
            behind = between(blocks, F.get(merged, F.size(merged) - 1)["end"], F.char_length(text).cast("long"))
            return F.concat(F.array_join(marked, ""), behind)

        return let(F.struct(found.alias("merged"), blocks_of(text).alias("blocks")), whole)

    return F.when(F.size(spans) > 0, let(_merged(spans), replaced)).otherwise(text)


def printed(spans: Column) -> Column:
    """`kind:start:end` of each span, joined by commas."""
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
    )
