"""Personal data by weak supervision: labelers vote, their reliabilities are estimated, a classifier decides.

Base spans (email, ip, card, phone) follow fixed patterns and always stay. Beyond them there
are candidates that a pattern alone cannot decide: secrets, card-like and phone-like
numbers that fail the base checks, email addresses with spelled-out signs and names.
Labelers of three sorts look at each candidate: regular expressions (its form),
gazetteers (known words in and before it) and context (words and signs nearby). Each
votes for, against or not at all. Expectation-maximisation estimates how reliable each
labeler is for each kind without any labelled data, and with that the probability of each
vote pattern; a logistic classifier of votes and form is trained on these, and candidates
that it gives ``LEAST`` or more become spans.

Only DataFrame functions run over the texts. The driver sees one count per vote pattern and kind:
at most 3 ** labelers for each kind, whatever the size of the corpus.

Patterns are written so that they take linear time: starts are bound to the start of a run
of their own characters (or the end of the last match), repetitions are possessive.
Nulls: a null text is empty. Texts are searched whole, and equal rows give equal results.
An empty table gives an empty result. Further columns pass through in ``row``.
"""

from __future__ import annotations

from math import exp, log

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarmac.llm.common import column, packed

# The base patterns, as kind and pattern, in the order of the output.
BASE = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++)(?:\.[0-9]++)(?:\.[0-9]++)",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# A text without a match of this has no match of the pattern either.
HINTS = {"email": "@", "ip": r"[0-9]\.[0-9]", "card": r"[0-9][\x20-]?[0-9]", "phone": r"\+[0-9]"}

# Candidates beyond the base spans.
CANDIDATES = {
    "secret": r"(?i)\b(?:api[_-]?key|access[_-]?key|token|secret|password|passwd|pwd)\b[\x20]?[:=][\x20]?[\"']?[A-Za-z0-9_+/=-]{8,200}",
    "number": r"(?<![0-9A-Za-z+.-])[(]?[0-9]{2,4}[)]?(?:[\x20-][0-9]{2,6}){1,5}(?![0-9A-Za-z.-])|(?<![0-9A-Za-z.-])[0-9]{13,19}(?![0-9A-Za-z.-])",
    "address": r"(?i)\b[a-z0-9_-]{2,30}[\x20](?:\(at\)|\[at\])[\x20][a-z0-9-]{2,30}(?:[\x20]?(?:\.|\(dot\)|\[dot\])[\x20]?[a-z]{2,10})++",
    "name": r"\b(?:Mr|Mrs|Ms|Dr|Herr|Frau|Mme|Sr|Sra)\.?[\x20][A-Z][a-z]{1,20}(?:[\x20][A-Z][a-z]{1,20})?",
}
CANDIDATE_HINTS = {
    "secret": "[:=]",
    "number": r"[0-9]{2}[)]?[\x20-][0-9]|[0-9]{13}",
    "address": r"(?i)[(\[]at[)\]]",
    "name": r"\b(?:Mr|Mrs|Ms|Dr|Herr|Frau|Mme|Sr|Sra)\b",
}
# Few texts hold any sign of the patterns above; one look for these leaves out the others.
ANY_HINT = r"[0-9@:=]|[(\[][Aa][Tt][)\]]|\b[MDHFS](?:rs|ra|r|s|err|rau|me)\b"
CONTEXT = 40

# Gazetteers: words that tell personal data from other data.
OWNER_WORDS = "name|mail|email|phone|tel|call|contact|card|visa|account|konto|carte|tarjeta|ssn|passport|token|secret|password|key"
OTHER_WORDS = "version|chapter|page|isbn|article|figure|table|part|model|order|example|sample|dummy|lorem"

LEAST = 0.9
STEPS = 30


def labelers(kind: str, c: Column) -> list[Column]:
    """Votes on a candidate (struct of ``found``, ``before`` and ``after``): 1, -1 or 0."""
    found, before, after = c["found"], c["before"], c["after"]
    digits = F.length(F.regexp_replace(found, "[^0-9]", ""))
    vote = lambda yes, no: F.when(yes, 1).when(no, -1).otherwise(0)
    one_sign = found.rlike(r"([0-9A-Za-z])\1{5}")
    form = {
        "secret": vote(found.rlike("[0-9]") & found.rlike(r"[A-Za-z0-9_+/=-]{16}"), ~found.rlike("[0-9]")),
        "number": vote(digits.between(9, 19), digits < 9),
        "address": vote(found.rlike(r"(?i)(?:com|org|net|de|fr|es)$"), F.lit(False)),
        "name": vote(found.rlike(r"[\x20][A-Z][a-z]+[\x20][A-Z]"), F.lit(False)),
    }[kind]
    return [
        form,
        vote(before.rlike(rf"(?i)\b(?:{OWNER_WORDS})\b") | found.rlike(rf"(?i)^(?:{OWNER_WORDS})\b"),
             before.rlike(rf"(?i)\b(?:{OTHER_WORDS})\b")),
        vote(before.rlike(r"[:=\x22(][\x20]?$"), before.rlike(r"[0-9]$|[0-9][\x20][+*/|]?[\x20]?$")),
        vote(F.lit(False), one_sign | found.rlike("1234567|0000000")),
        vote(after.rlike(r"^[\x22\x27]?[\x20\n.,;]") | (after == ""), after.rlike(r"^[%€$]|^[\x20]?(?:km|kg|cm|mm)\b")),
    ]


N_LABELERS = 5


def located(text: Column, pattern: str, hint: str) -> tuple[Column, Column]:
    """Matches and the pieces of text between them; empty for texts without the hint."""
    some = text.rlike(hint)
    empty = F.array().cast("array<string>")
    return (
        F.when(some, F.regexp_extract_all(text, F.lit(pattern), F.lit(0))).otherwise(empty),
        F.when(some, F.split(text, pattern, -1)).otherwise(empty),
    )


def _spans(kind: str, found: str, between: str) -> str:
    """SQL for the matches as structs of ``kind``, ``start``, ``stop`` and ``found``, offsets in code points."""
    return f"""aggregate(sequence(1, size({found})), named_struct('at', 0, 'out', cast(array() as
        array<struct<kind:string,start:int,stop:int,found:string,place:int>>)),
      (acc, i) -> named_struct(
        'at', acc.at + length(get({between}, i - 1)) + length(get({found}, i - 1)),
        'out', array_append(acc.out, named_struct('kind', '{kind}',
          'start', acc.at + length(get({between}, i - 1)),
          'stop', acc.at + length(get({between}, i - 1)) + length(get({found}, i - 1)),
          'found', get({found}, i - 1), 'place', i))),
      acc -> acc.out)"""


def _all_spans(kind: str) -> Column:
    none = "cast(array() as array<struct<kind:string,start:int,stop:int,found:string,place:int>>)"
    found, between = f"found_{kind}", f"between_{kind}"
    return F.expr(f"case when size({found}) > 0 then {_spans(kind, found, between)} else {none} end")


# Conditions on a match ``s``, in SQL.
_DIGITS = "translate(s.found, ' -', '')"
PASSES = {
    "email": "true",
    "ip": "forall(split(s.found, '[.]'), p -> length(trim(leading '0' from p)) <= 3 and cast('0' || right(p, 3) as int) <= 255)",
    "card": f"""length({_DIGITS}) between 13 and 19 and
        aggregate(sequence(1, length({_DIGITS})), 0, (sum, i) -> sum + case
          when (length({_DIGITS}) - i) % 2 = 0 then cast(substr({_DIGITS}, i, 1) as int)
          else cast(substr('0246813579', cast(substr({_DIGITS}, i, 1) as int) + 1, 1) as int) end) % 10 = 0""",
    "phone": "length(regexp_replace(s.found, '[^0-9]', '')) between 9 and 15",
}


def searched(docs: DataFrame, text: str = "text") -> DataFrame:
    """``row``, base spans by kind (``email``, ``ip``, ...) and the ``candidates``, each with
    ``kind``, ``start``, ``stop``, ``found``, ``before`` and ``after``."""
    t = column(text)
    rows = docs.select(packed(docs), F.when(t.rlike(ANY_HINT), t).otherwise("").alias("t"))
    patterns = [(k, p, HINTS[k]) for k, p in BASE.items()] + [(k, p, CANDIDATE_HINTS[k]) for k, p in CANDIDATES.items()]
    for kind, pattern, hint in patterns:
        found, between = located(F.col("t"), pattern, hint)
        rows = rows.withColumns({f"found_{kind}": found, f"between_{kind}": between})
        rows = rows.withColumn(kind, _all_spans(kind))
    for kind in BASE:
        rows = rows.withColumn(kind, F.expr(f"filter({kind}, s -> {PASSES[kind]})"))
    taken = f"concat({', '.join(BASE)})"
    rows = rows.withColumn("base", F.expr(taken))
    for kind in CANDIDATES:
        free = f"filter({kind}, s -> not exists(base, b -> b.start < s.stop and s.start < b.stop))"
        near = f"""transform({free}, s -> named_struct('kind', s.kind, 'start', s.start, 'stop', s.stop, 'found', s.found,
            'before', right(get(between_{kind}, s.place - 1), {CONTEXT}), 'after', left(get(between_{kind}, s.place), {CONTEXT})))"""
        rows = rows.withColumn(kind, F.expr(near))
    candidates = F.expr(f"concat({', '.join(CANDIDATES)})")
    return rows.select("row", *BASE, "base", candidates.alias("candidates"))


def vote_counts(found: DataFrame) -> DataFrame:
    """One row per kind and vote pattern: ``kind``, ``votes`` and the number ``n`` of candidates."""
    each = found.select(F.explode("candidates").alias("c"))
    votes = F.lit(None).cast("array<int>")
    for kind in CANDIDATES:
        votes = F.when(F.col("c.kind") == kind, F.array(*labelers(kind, F.col("c")))).otherwise(votes)
    return each.select("c.kind", votes.alias("votes")).groupBy("kind", "votes").agg(F.count("*").alias("n"))


Pattern = tuple[int, ...]


def estimated(counts: dict[Pattern, int]) -> dict[Pattern, float]:
    """Probability of each vote pattern to be personal data, by expectation-maximisation.

    Labelers are taken to vote independently given the truth. Each has a chance for every
    vote if the truth is yes and if it is no; both start from a majority vote and take
    turns with the probabilities of the patterns.
    """
    belief = {v: 1 / (1 + exp(-1.5 * sum(v))) for v in counts}
    total = sum(counts.values())
    for _ in range(STEPS):
        yes = sum(n * belief[v] for v, n in counts.items())
        prior = (yes + 1) / (total + 2)
        rate: list[dict[int, tuple[float, float]]] = []
        for k in range(N_LABELERS):
            seen = {x: [1.0, 1.0] for x in (-1, 0, 1)}
            # Some weight on the side that a labeler speaks for keeps it from being turned around.
            seen[1][0] += 2.0
            seen[-1][1] += 2.0
            for v, n in counts.items():
                seen[v[k]][0] += n * belief[v]
                seen[v[k]][1] += n * (1 - belief[v])
            sums = [sum(s[side] for s in seen.values()) for side in (0, 1)]
            rate.append({x: (s[0] / sums[0], s[1] / sums[1]) for x, s in seen.items()})
        for v in counts:
            odds = log(prior / (1 - prior)) + sum(log(rate[k][x][0] / rate[k][x][1]) for k, x in enumerate(v))
            belief[v] = 1 / (1 + exp(-max(-30.0, min(30.0, odds))))
    return belief


def trained(counts: dict[Pattern, int], belief: dict[Pattern, float]) -> list[float]:
    """Weights of a logistic classifier of the votes (for, against) and a constant, by gradient steps
    on the expected labels."""
    weights = [0.0] * (2 * N_LABELERS + 1)
    total = sum(counts.values())
    for _ in range(400):
        slope = [0.001 * w for w in weights]
        for v, n in counts.items():
            x = features(v)
            p = 1 / (1 + exp(-max(-30.0, min(30.0, sum(a * b for a, b in zip(weights, x))))))
            for i, b in enumerate(x):
                slope[i] += n / total * (p - belief[v]) * b
        weights = [w - 1.5 * s for w, s in zip(weights, slope)]
    return weights


def features(votes: Pattern) -> list[float]:
    return [float(x > 0) for x in votes] + [float(x < 0) for x in votes] + [1.0]


def classifiers(found: DataFrame) -> dict[str, list[float]]:
    """Weights per kind of candidate."""
    by_kind: dict[str, dict[Pattern, int]] = {}
    for row in vote_counts(found).collect():
        by_kind.setdefault(row["kind"], {})[tuple(row["votes"])] = row["n"]
    result = {}
    for kind, counts in sorted(by_kind.items()):
        counts = dict(sorted(counts.items()))
        result[kind] = trained(counts, estimated(counts))
    return result


def detected(docs: DataFrame, text: str = "text") -> DataFrame:
    """``row``, the base spans by kind and ``added``, the spans that the classifier adds."""
    found = searched(docs, text)
    weights = classifiers(found)

    def likely(c: Column) -> Column:
        yes = F.lit(False)
        for kind, w in weights.items():
            yes = yes | ((c["kind"] == kind) & (_logit(kind, w, c) >= log(LEAST / (1 - LEAST))))
        return yes

    return found.withColumn("added", F.filter("candidates", likely))


def _logit(kind: str, w: list[float], c: Column) -> Column:
    total = F.lit(w[-1])
    for k, vote in enumerate(labelers(kind, c)):
        total = total + F.when(vote > 0, w[k]).when(vote < 0, w[N_LABELERS + k]).otherwise(0.0)
    return total


def written(spans: Column) -> Column:
    """Spans as the text ``kind:start:stop`` joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["stop"])), ",")
