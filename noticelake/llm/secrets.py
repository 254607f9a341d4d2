"""Secret scans: fixed patterns, and a battery of randomness tests.

Patterns find assigned passwords and tokens, access keys and hex keys. Beside them every run
of 20 or more key characters with letters and digits is a candidate. Its encoding is inferred
(hex, base 32, base 64) and its symbols, as numbers, are tested for what a random key has: a
chi-squared test of uniform use of the alphabet in eight parts, a runs test about the middle,
and the correlation of neighbours. Fisher's method combines the three p-values.

Small p-values speak for structure, which names and addresses have. A step-up procedure of
Benjamini and Hochberg, apart for each encoding and length band, decides over the whole corpus
which candidates are structured, so that no more than a set share of those set aside are truly
random; the share is larger for short candidates, where the tests see little. What is
left is a span of kind ``random``. The procedure steps over a fixed grid of p-values, 100 a
decade, so that counts per step, not sorted candidates, are gathered.

Positions are code points, ends exclusive. A null text counts as empty and has no spans.
Repeated rows count each. Only the id and the text are read. Built-in functions alone run.
"""

from __future__ import annotations

from math import sqrt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from noticelake.llm.common import let, settled

# The patterns of the base kinds.
_KEYWORDS = "([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])"
ASSIGN = _KEYWORDS + r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = "AKIA[A-Z0-9]+"
HEX = "[0-9a-f]+"

KINDS = ("assign", "access", "hex", "random")
CANDIDATE = "[A-Za-z0-9+/_=-]{20,}"
# Least length of a band, and the share of random strings allowed among those set aside.
BANDS = ((20, 0.20), (32, 0.10), (48, 0.05), (96, 0.02))
ENCODINGS = (
    ("^([0-9a-f]+|[0-9A-F]+)$", "0123456789abcdef"),
    ("^[A-Z2-7]+=*$", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"),
    ("", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"),
)
_PARTS = 8
_STEPS, _MOST_STEP = 100, 3000


def _found(text: Column, pattern: str, rank: int, passes) -> Column:
    """Spans ``start, rank, end, hit`` of the leftmost matches that pass."""

    def walk(gaps: Column, hits: Column) -> Column:
        def step(state: Column, pair: Column) -> Column:
            start = state["at"] + F.length(pair["gap"])
            end = start + F.length(pair["hit"])
            span = F.struct(start.alias("start"), F.lit(rank).alias("rank"), end.alias("end"), pair["hit"].alias("hit"))
            spans = F.when(passes(pair["hit"]), F.concat(state["spans"], F.array(span))).otherwise(state["spans"])
            return F.struct(end.alias("at"), spans.alias("spans"))

        pairs = F.zip_with(
            F.slice(gaps, F.lit(1), F.size(hits)), hits, lambda g, h: F.struct(g.alias("gap"), h.alias("hit"))
        )
        return F.aggregate(pairs, F.struct(F.lit(0).alias("at"), _none().alias("spans")), step, lambda s: s["spans"])

    gaps, hits = F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    return F.when(text.rlike(pattern), let(gaps, lambda g: let(hits, lambda h: walk(g, h)))).otherwise(_none())


def _none() -> Column:
    return F.array().cast("array<struct<start:int,rank:int,end:int,hit:string>>")


def base_spans(text: Column) -> Column:
    value = lambda hit: F.length(F.regexp_extract(hit, ASSIGN, 2)) >= 8
    # A run of hex digits is found whole, so asking for its length in the pattern changes nothing.
    return F.concat(
        _found(text, ASSIGN, 0, value),
        _found(text, ACCESS, 1, lambda hit: F.length(hit) >= 16),
        _found(text, "[0-9a-f]{32,}", 2, lambda hit: F.length(hit) >= 32),
    )


def _two_sided(z: Column) -> Column:
    """Chance that a normal value is as far from zero; error below 2e-7."""
    x = F.abs(z) / sqrt(2)
    t = 1 / (1 + 0.3275911 * x)
    # A published polynomial for the error function.
    poly = t * (0.254829592 + t * (-0.284496736 + t * (1.421413741 + t * (-1.453152027 + t * 1.061405429))))
    return poly * F.exp(-x * x)


def chi_squared_p(symbols: Column, alphabet: Column) -> Column:
    n = F.size(symbols)
    share = alphabet / _PARTS
    parts = F.sequence(F.lit(0), F.lit(_PARTS - 1))
    expected = n / _PARTS
    counts = F.transform(parts, lambda b: F.size(F.filter(symbols, lambda x: F.floor(x / share) == b)))
    total = F.aggregate(counts, F.lit(0.0), lambda a, o: a + (o - expected) * (o - expected) / expected)
    freedom = _PARTS - 1
    spread = 2 / (9 * freedom)
    z = (F.cbrt(total / freedom) - (1 - spread)) / sqrt(spread)
    upper = _two_sided(z) / 2
    return F.when(z >= 0, upper).otherwise(1 - upper)


def runs_p(symbols: Column, alphabet: Column) -> Column:
    n = F.size(symbols)
    high = F.size(F.filter(symbols, lambda x: x >= alphabet / 2))
    low = n - high
    changes = F.aggregate(
        symbols,
        F.struct(F.lit(0).alias("n"), F.lit(None).cast("boolean").alias("side")),
        lambda s, x: F.struct(
            (s["n"] + F.coalesce((s["side"] != (x >= alphabet / 2)).cast("int"), F.lit(0))).alias("n"),
            (x >= alphabet / 2).alias("side"),
        ),
        lambda s: s["n"],
    )
    mean = 2.0 * high * low / n + 1
    spread = (mean - 1) * (mean - 2) / (n - 1)
    return F.when(spread > 0, _two_sided((changes + 1 - mean) / F.sqrt(spread))).otherwise(0.0)


def serial_p(symbols: Column) -> Column:
    n = F.size(symbols)
    mean = F.aggregate(symbols, F.lit(0.0), lambda a, x: a + x) / n
    sums = F.aggregate(
        symbols,
        F.struct(F.lit(0.0).alias("own"), F.lit(0.0).alias("next"), F.lit(None).cast("double").alias("last")),
        lambda s, x: F.struct(
            (s["own"] + (x - mean) * (x - mean)).alias("own"),
            (s["next"] + F.coalesce((x - mean) * s["last"], F.lit(0.0))).alias("next"),
            (x - mean).alias("last"),
        ),
    )
    return let(
        sums,
        lambda s: F.when(s["own"] > 0, _two_sided((s["next"] / s["own"] + 1 / n) * F.sqrt(n))).otherwise(0.0),
    )


def battery_p(symbols: Column, alphabet: Column) -> Column:
    """The combined p-value of the three tests."""
    tiny = F.lit(1e-12)
    half = -(
        F.ln(F.greatest(chi_squared_p(symbols, alphabet), tiny))
        + F.ln(F.greatest(runs_p(symbols, alphabet), tiny))
        + F.ln(F.greatest(serial_p(symbols), tiny))
    )
    return let(half, lambda h: F.exp(-h) * (1 + h + h * h / 2))


def candidates(text: Column) -> Column:
    """``start, end, stratum, step`` of each candidate; the step is the grid place of its p-value."""
    mixed = lambda hit: hit.rlike("[0-9]") & hit.rlike("[A-Za-z]")

    def judged(span: Column) -> Column:
        hit, n = span["hit"], F.length(span["hit"])
        kind = F.lit(len(ENCODINGS) - 1)
        for i in reversed(range(len(ENCODINGS) - 1)):
            kind = F.when(hit.rlike(ENCODINGS[i][0]), i).otherwise(kind)
        band = F.lit(0)
        for i, (least, _) in enumerate(BANDS):
            band = F.when(n >= least, i).otherwise(band)
        alphabets = F.array(*[F.lit(a) for _, a in ENCODINGS])

        def tested(k: Column) -> Column:
            alphabet = F.get(alphabets, k)
            plain = F.when(k == 0, F.lower(hit)).otherwise(F.translate(F.rtrim(hit, F.lit("=")), "-_", "+/"))
            symbols = F.transform(F.split(plain, ""), lambda c: F.instr(alphabet, c) - 1)
            inside = F.filter(symbols, lambda x: x >= 0)
            p = let(inside, lambda s: battery_p(s, F.length(alphabet)))
            step = F.least(F.floor(-F.log10(F.greatest(p, F.lit(1e-30))) * _STEPS), F.lit(_MOST_STEP)).cast("int")
            return F.struct(
                span["start"].alias("start"), span["end"].alias("end"), (k * len(BANDS) + band).alias("stratum"), step.alias("step")
            )

        return let(kind, tested)

    return F.transform(_found(text, CANDIDATE, 3, mixed), judged)


def step_limits(found: DataFrame) -> dict[int, int]:
    """For each stratum the least grid step whose candidates are set aside as structured."""
    counts = found.select(F.explode("candidates").alias("c")).groupBy("c.stratum", "c.step").agg(F.count("*").alias("n"))
    # One row per stratum and grid step.
    downward = Window.partitionBy("stratum").orderBy(F.desc("step")).rowsBetween(Window.unboundedPreceding, 0)
    every = Window.partitionBy("stratum")
    shares = F.array(*[F.lit(share) for _, share in BANDS])
    allowed = F.get(shares, F.col("stratum") % len(BANDS))
    met = F.pow(F.lit(10.0), -F.col("step") / _STEPS) * F.sum("n").over(every) <= allowed * F.sum("n").over(downward)
    limits = counts.select("stratum", "step", met.alias("met")).where("met").groupBy("stratum").agg(F.min("step").alias("step"))
    return {r.stratum: r.step for r in limits.collect()}


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, base, random``: arrays of spans ``start, rank, end`` for every row."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    bare = lambda spans: F.transform(spans, lambda s: F.struct(s["start"], s["rank"], s["end"]))
    found = settled(
        docs.select(
            F.col(id_col).alias("doc_id"), F.sort_array(bare(base_spans(text))).alias("base"), candidates(text).alias("candidates")
        )
    )
    limits = step_limits(found)
    strata = len(ENCODINGS) * len(BANDS)
    least = F.array(*[F.lit(limits.get(i, _MOST_STEP + 1)) for i in range(strata)])
    left = F.filter("candidates", lambda c: c["step"] < F.get(least, c["stratum"]))
    random = F.transform(left, lambda c: F.struct(c["start"].alias("start"), F.lit(3).alias("rank"), c["end"].alias("end")))
    return found.select("doc_id", "base", random.alias("random"))


def spans_text(spans: Column) -> Column:
    """``kind:start:end`` of sorted spans, joined by commas."""
    kinds = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(kinds, s["rank"]), s["start"], s["end"])), ",")
