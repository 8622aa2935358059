"""Secrets in text: fixed patterns, and strings that a battery of randomness tests cannot tell from noise.

Every step is a column expression. Patterns are searched only where a cheap test allows a match. Offsets are code
points: the text is cut at the matches, and the lengths of pieces and matches are summed up.

The battery looks at runs of 20 or more characters of the usual encodings that hold a digit and a letter and overlap
no pattern match. The narrowest encoding that holds all characters gives the alphabet. Three statistics are compared
with what uniform noise of that length would give:

* chi-squared of the symbol counts, with its exact mean and variance for a short string;
* the number of runs above and below the middle of the alphabet;
* the correlation of neighbouring symbols.

Their squares add up to a chi-squared of three degrees, hence a p-value of "this is noise". Over all candidates of the
corpus, p-values weighted by length go through the Benjamini-Hochberg rule: strings rejected there are words, paths
and names; what is not rejected and carries ``LEAST_BITS`` is reported. The rule works on counts in fixed bins of the
p-value, so it gathers a bounded table whatever the corpus.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The patterns of the task, kinds in their stated order.
KINDS = ("assign", "access", "hex", "noise")
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
LEAST_VALUE = 6
#: What lower-cased text must hold for the assignment pattern to match at all.
HINTS = ("passw", "secret", "token", "api")

SYMBOLS = r"[A-Za-z0-9+/_=-]"
NOISE = SYMBOLS + "{20,}"
#: A digit with ten symbols on one side: every candidate has one.
NOISE_HINT = f"[0-9](?:(?={SYMBOLS}{{10}})|(?<={SYMBOLS}{{10}}[0-9]))"
#: Encodings from narrow to wide, with their alphabets in order of value.
ENCODINGS = (
    "0123456789abcdef",
    "0123456789ABCDEF",
    "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567",
    "0123456789abcdefghijklmnopqrstuvwxyz",
    "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789",
    "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/",
    "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789-_",
)
#: Share of noise that the rule may take for words, the information a secret carries, and bins per decade of p.
FALSE_RATE, LEAST_BITS = 0.05, 72.0
BINS, DECADES = 100, 30
SPAN = "struct<kind:string,start:int,end:int>"
#: Lengths summed in one stretch, so that long lists of matches cost no square.
STRETCH = 256


def _running(lengths: Column) -> Column:
    """Sums of an array of ints up to and including each element."""

    def within(part: Column, start: Column) -> Column:
        state = F.struct(start.alias("sum"), F.expr("cast(array() as array<int>)").alias("all"))
        step = lambda s, x: F.struct((s["sum"] + x).alias("sum"), F.array_append(s["all"], s["sum"] + x).alias("all"))
        return F.aggregate(part, state, step, lambda s: s["all"])

    count = F.ceil(F.size(lengths) / STRETCH).cast("int")
    parts = F.transform(F.sequence(F.lit(0), F.greatest(count - 1, F.lit(0))), lambda i: F.slice(lengths, i * STRETCH + 1, STRETCH))
    sums = within(F.transform(parts, lambda p: F.aggregate(p, F.lit(0), lambda s, x: s + x)), F.lit(0))
    starts = F.concat(F.array(F.lit(0)), sums)
    return F.flatten(F.transform(parts, lambda p, i: within(p, F.element_at(starts, i + 1))))


def _found(text: Column, pattern: str) -> Column:
    """Array of (start, end, match) of a pattern's leftmost non-overlapping matches, in code points."""
    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.transform(F.split(text, pattern, -1), F.length)
    widths = F.transform(matches, F.length)
    ends = _running(F.zip_with(F.slice(gaps, 1, F.size(widths)), widths, lambda g, w: g + w))
    one = lambda m, e: F.struct((e - F.length(m)).alias("start"), e.alias("end"), m.alias("match"))
    return F.zip_with(matches, ends, one)


def _spans(kind: str, found: Column) -> Column:
    return F.transform(found, lambda m: F.struct(F.lit(kind).alias("kind"), m["start"].alias("start"), m["end"].alias("end")))


def _when(test: Column, spans: Column, kind: str = SPAN) -> Column:
    return F.when(test, spans).otherwise(F.expr(f"cast(array() as array<{kind}>)"))


def base_spans(text: Column) -> Column:
    """Spans of the three fixed patterns by kind, unsorted; null text counts as empty."""
    text = F.coalesce(text, F.lit(""))
    lower = F.lower(text)
    hinted = lower.contains(HINTS[0])
    for hint in HINTS[1:]:
        hinted = hinted | lower.contains(hint)
    value = F.regexp_extract_all(text, F.lit(ASSIGN), F.lit(2))
    assigned = F.zip_with(_found(text, ASSIGN), value, lambda m, v: F.struct(m["start"].alias("start"), m["end"].alias("end"), v.alias("value")))
    assigned = F.filter(assigned, lambda m: F.length(m["value"]) >= LEAST_VALUE)
    return F.concat(
        _when(hinted, _spans("assign", assigned)),
        _when(text.contains("AKIA"), _spans("access", _found(text, ACCESS))),
        _when(text.rlike(HEX), _spans("hex", _found(text, HEX))),
    )


def _noise_test(match: Column) -> Column:
    """p-value of noise, divided by a weight of length, and the bits carried; null if no encoding or no digit and letter."""
    plain = F.rtrim(match, F.lit("="))
    alphabet = F.lit(None).cast("string")
    for symbols in reversed(ENCODINGS):
        alphabet = F.when(F.length(F.translate(plain, symbols, "")) == 0, F.lit(symbols)).otherwise(alphabet)
    n, k = F.length(plain).cast("double"), F.length(alphabet).cast("double")
    values = F.transform(F.filter(F.split(plain, ""), lambda c: c != ""), lambda c: F.instr(alphabet, c).cast("double"))
    state = F.struct(
        *[F.lit(0.0).alias(x) for x in ("sum", "squares", "products", "runs", "high", "last", "side")]
    )

    def step(s: Column, v: Column) -> Column:
        side = F.when(v > (k / 2), F.lit(1.0)).otherwise(F.lit(-1.0))
        return F.struct(
            (s["sum"] + v).alias("sum"),
            (s["squares"] + v * v).alias("squares"),
            (s["products"] + v * s["last"]).alias("products"),
            (s["runs"] + F.when(side != s["side"], F.lit(1.0)).otherwise(F.lit(0.0))).alias("runs"),
            (s["high"] + F.when(side > 0, F.lit(1.0)).otherwise(F.lit(0.0))).alias("high"),
            v.alias("last"),
            side.alias("side"),
        )

    def judge(s: Column) -> Column:
        distinct = F.array_distinct(values)
        twice = F.aggregate(distinct, F.lit(0.0), lambda t, v: t + F.pow(n - F.size(F.array_remove(values, v)), 2.0))
        chi = (k / n * twice - n - (k - 1)) / F.sqrt(2 * (k - 1) * (n - 1) / n)
        low = n - s["high"]
        expected = 2 * s["high"] * low / n + 1
        spread = (expected - 1) * (expected - 2) / (n - 1)
        runs = F.when(spread > 0, (s["runs"] - expected) / F.sqrt(spread)).otherwise(F.lit(6.0))
        mean = s["sum"] / n
        variance = s["squares"] - n * mean * mean
        first, last = F.element_at(values, 1), F.element_at(values, -1)
        lagged = s["products"] - mean * (2 * s["sum"] - first - last) + (n - 1) * mean * mean
        serial = F.when(variance > 0, F.sqrt(n) * (lagged / variance + 1 / n)).otherwise(F.lit(6.0))
        total = F.pow(F.greatest(chi, F.lit(0.0)), 2.0) + runs * runs + serial * serial
        normal = (F.cbrt(total / 3) - (1 - 2 / 27)) / (2 / 27) ** 0.5
        p = 1 / (1 + F.exp(1.5976 * normal + 0.070566 * normal * normal * normal))
        return F.struct(p.alias("p"), (n * F.log2(k)).alias("bits"), n.alias("length"))

    usable = alphabet.isNotNull() & plain.rlike("[0-9]") & plain.rlike("[A-Za-z]")
    return F.when(usable, F.aggregate(values, state, step, judge))


def noise_candidates(text: Column, base: Column) -> Column:
    """Array of (start, end, p, bits, length) of the strings to test that overlap no span of ``base``."""
    text = F.coalesce(text, F.lit(""))
    apart = lambda m: ~F.exists(base, lambda b: (b["start"] < m["end"]) & (m["start"] < b["end"]))
    tested = F.transform(
        F.filter(_found(text, NOISE), apart),
        lambda m: F.struct(m["start"].alias("start"), m["end"].alias("end"), _noise_test(m["match"]).alias("test")),
    )
    tested = F.filter(tested, lambda m: m["test"].isNotNull())
    return _when(text.rlike(NOISE_HINT), tested, "struct<start:int,end:int,test:struct<p:double,bits:double,length:double>>")


def _bin(test: Column, mean: float) -> Column:
    weighted = F.least(test["p"] * mean / test["length"], F.lit(1.0))
    return F.least(F.floor(-F.log10(F.greatest(weighted, F.lit(10.0**-DECADES))) * BINS), F.lit(DECADES * BINS - 1))


def noise_threshold(candidates: DataFrame, false_rate: float = FALSE_RATE) -> tuple[float, int]:
    """Mean length, and the lowest bin of weighted p-values that the Benjamini-Hochberg rule rejects.

    ``candidates`` has one ``test`` a row. A bin counts with its largest p-value, so binning only rejects less.
    """
    mean = candidates.agg(F.avg("test.length")).first()[0] or 1.0
    counts = {r[0]: r[1] for r in candidates.groupBy(_bin(F.col("test"), mean).alias("bin")).count().collect()}
    total, seen, cut = sum(counts.values()), 0, DECADES * BINS
    for b in sorted(counts, reverse=True):
        seen += counts[b]
        if 10.0 ** (-b / BINS) <= false_rate * seen / total:
            cut = b
    return mean, cut


def scan_secrets(documents: DataFrame, *, text: str = "text", out: str = "secrets") -> DataFrame:
    """``documents`` with an array of spans (``kind``, ``start``, ``end``) by start and kind.

    Offsets are code points, ends exclusive. Null and empty texts have no spans. A column named ``out`` is replaced.
    """
    taken = [F.col(f"`{c}`") for c in documents.columns if c.lower() != out.lower()]
    based = documents.select(*taken, base_spans(F.col(text)).alias(out))
    tested = documents.where(F.col(text).rlike(NOISE_HINT)).select(F.col(text).alias("text"))
    tested = tested.select(F.explode(noise_candidates(F.col("text"), base_spans(F.col("text")))).alias("one")).select("one.test")
    mean, cut = noise_threshold(tested)
    noise = F.filter(
        noise_candidates(F.col(text), F.col(out)), lambda m: (_bin(m["test"], mean) < cut) & (m["test"]["bits"] >= LEAST_BITS)
    )
    order = F.create_map(*[x for i, kind in enumerate(KINDS) for x in (F.lit(kind), F.lit(i))])
    spans = F.transform(
        F.array_sort(
            F.transform(
                F.concat(F.col(out), _spans("noise", noise)),
                lambda s: F.struct(s["start"].alias("start"), order[s["kind"]].alias("rank"), s["end"].alias("end"), s["kind"].alias("kind")),
            )
        ),
        lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end")),
    )
    return based.withColumn(out, spans)


def redact(text: Column, spans: Column, mark: str = "[SECRET]") -> Column:
    """The text with every span (sorted by start, overlaps allowed) replaced by a mark; adjoining spans share one."""
    state = F.struct(F.lit(0).alias("at"), F.lit("").alias("kept"))

    def step(s: Column, x: Column) -> Column:
        fresh = (x["start"] > s["at"]) | ((s["at"] == 0) & (s["kept"] == ""))
        piece = F.concat(s["kept"], F.substring(text, s["at"] + 1, x["start"] - s["at"]), F.lit(mark))
        return F.struct(F.greatest(s["at"], x["end"]).alias("at"), F.when(fresh, piece).otherwise(s["kept"]).alias("kept"))

    rest = lambda s: F.concat(s["kept"], F.substring(text, s["at"] + 1, F.length(text)))
    return F.when(F.size(spans) > 0, F.aggregate(spans, state, step, rest)).otherwise(text)
