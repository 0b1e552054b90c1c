"""Secret scan with DataFrame functions only: pattern matches, and windows of high Shannon entropy.

Candidates of the entropy method are runs of at least ``WINDOW`` token characters that hold a digit. Each falls
into one character class (hex, upper, alphanumeric, base64), and a window of ``WINDOW`` characters slides over
it. Its counts change incrementally: one character enters, one leaves, and the sum of ``c * log2(c)`` changes
by two table look-ups. The work is linear in the length of a run, and near linear in the number of matches of a text. The run is reported where its highest window entropy reaches the class's threshold,
unless the allow list knows it (UUIDs, digests announced as such, sequences, documented sample keys).

Defined cases: a null text counts as empty and has no spans; repeated rows repeat; empty tables give empty
tables; equal starts are ordered by kind. Spans of the entropy method that overlap a pattern match are left out.
"""

from __future__ import annotations

from math import log2

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WINDOW = 20

# Patterns of the three kinds (a run shorter than the minimum never passes, so hex and access carry it).
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ASSIGN_MIN = 6
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"(?<![0-9a-f])[0-9a-f]{24,}"
CANDIDATE = r"(?<![A-Za-z0-9+/_=-])(?=[A-Za-z+/_=-]*+[0-9])[A-Za-z0-9+/_=-]{20,}+"

#: Character classes, tried in this order, with the window entropy in bits from which a run is reported.
CLASSES = (
    ("hex", "^[0-9a-fA-F]+$", 3.0),
    ("upper", "^[A-Z0-9]+$", 3.3),
    ("alnum", "^[A-Za-z0-9]+$", 3.6),
    ("base64", "^.+$", 3.8),
)

#: Runs that are no secrets although they look random.
ALLOWED = (
    r"^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$",
    r"^(sha1|sha256|sha512|md5)[-=_].*$",
    r"(?i)example|sample|placeholder|changeme|xxxx|0123456789|abcdefghij",
    r"^[0-9-]+$",
)

KINDS = ("assign", "access", "hex", "entropy")


_SPAN = "struct<start:int,place:int,end:int,kind:string,found:string>"
#: Spans of a block. A fold copies its whole state at each step, so positions are summed by blocks instead.
BLOCK = 128


def _let(value: Column, use) -> Column:
    """``use`` of a value that is computed once."""
    return F.transform(F.array(value), use)[0]


def _total(numbers: Column) -> Column:
    return F.aggregate(numbers, F.lit(0), lambda a, b: a + b)


def _upto(n: Column) -> Column:
    """0 to ``n`` - 1; no numbers for 0."""
    return F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.expr("array()").cast("array<int>"))


def _sums_before(numbers: Column) -> Column:
    """For each number the sum of those before it, by sums of blocks."""
    block_of = lambda k: F.floor(k / BLOCK).cast("int")

    def summed(xs):
        blocks = F.transform(_upto(block_of(F.size(xs) + BLOCK - 1)), lambda b: _total(F.slice(xs, b * BLOCK + 1, F.lit(BLOCK))))
        offsets = _let(blocks, lambda sums: F.transform(_upto(F.size(sums)), lambda b: _total(F.slice(sums, F.lit(1), b))))
        return _let(offsets, lambda before: F.transform(_upto(F.size(xs)), lambda k: F.get(before, block_of(k)) + _total(F.slice(xs, block_of(k) * BLOCK + 1, k % BLOCK))))

    return _let(numbers, summed)


def spans(text: Column, pattern: str, kind: str, keep=None) -> Column:
    """Array of ``(start, place, end, kind, match)`` of the leftmost non-overlapping matches, in code points."""
    matches = F.regexp_extract_all(text, F.lit(f"({pattern})"), 1)
    gaps = F.transform(F.split(text, pattern, -1), lambda g: F.char_length(g))  # one more than matches

    def placed(pairs):
        before = _sums_before(F.transform(pairs, lambda p: p["gap"] + F.char_length(p["found"])))

        def one(p):
            start = p["before"] + p["gap"]
            return F.struct(start.alias("start"), F.lit(KINDS.index(kind)).alias("place"), (start + F.char_length(p["found"])).alias("end"), F.lit(kind).alias("kind"), p["found"].alias("found"))

        whole = F.transform(F.arrays_zip(pairs.alias("pair"), before.alias("before")), lambda x: F.struct(x["before"].alias("before"), x["pair"]["gap"].alias("gap"), x["pair"]["found"].alias("found")))
        return F.transform(whole, one)

    both = F.filter(F.arrays_zip(gaps.alias("gap"), matches.alias("found")), lambda p: p["found"].isNotNull())
    found = _let(both, placed)
    return F.filter(found, keep) if keep is not None else found


def peak_entropy(run: Column, window: int = WINDOW) -> Column:
    """Highest Shannon entropy in bits of the windows of ``run``, which is at least ``window`` long.

    The state is the sum of ``c * log2(c)`` over the window's counts. A step looks up what one character that enters and
    one that leaves change; their counts are taken in the window itself, so the work on a run is linear.
    """
    weights = F.array(*[F.lit(c * log2(c) if c else 0.0) for c in range(window + 2)])

    def change(chars, char, first, size, more):
        """By how much the sum changes if the window's count of a character grows or falls by one."""
        count = F.size(F.filter(F.slice(chars, first, size), lambda c: c == char))
        return _let(count, lambda n: F.element_at(weights, n + 1 + more) - F.element_at(weights, n + 1))

    def peak(chars):
        def step(state, i):
            before = F.least(i - 1, F.lit(window))
            entered = change(chars, F.element_at(chars, i), F.greatest(i - window, F.lit(1)), before, 1)
            left = F.when(i > window, change(chars, F.get(chars, i - window - 1), i - window, F.lit(window + 1), -1)).otherwise(0.0)
            return _let(state["weight"] + entered + left, lambda w: F.struct(w.alias("weight"), F.greatest(state["best"], F.when(i >= window, log2(window) - w / window).otherwise(0.0)).alias("best")))

        start = F.struct(F.lit(0.0).alias("weight"), F.lit(0.0).alias("best"))
        return F.aggregate(F.sequence(F.lit(1), F.size(chars)), start, step, lambda s: s["best"])

    return _let(F.split(run, ""), peak)


def _apart(base: Column, runs: Column) -> Column:
    """Runs that overlap no base span; blocks of base spans that are out of reach are passed over as a whole."""
    overlap = lambda one, run: (one["start"] < run["end"]) & (run["start"] < one["end"])

    def block(spans, b):
        own = F.slice(spans, b * BLOCK + 1, F.lit(BLOCK))
        return F.struct(F.array_min(F.transform(own, lambda s: s["start"])).alias("start"), F.array_max(F.transform(own, lambda s: s["end"])).alias("end"), own.alias("spans"))

    def judged(spans):
        blocks = F.transform(_upto(F.ceil(F.size(spans) / BLOCK).cast("int")), lambda b: block(spans, b))
        return _let(blocks, lambda bs: F.filter(runs, lambda run: ~F.exists(bs, lambda x: overlap(x, run) & F.exists(x["spans"], lambda s: overlap(s, run)))))

    return _let(base, judged)


def _threshold(run: Column) -> Column:
    column = F.lit(CLASSES[-1][2])
    for _, pattern, bits in reversed(CLASSES[:-1]):
        column = F.when(run.rlike(pattern), bits).otherwise(column)
    return column


def _suspicious(span: Column) -> Column:
    run = span["found"]
    allowed = F.lit(False)
    for pattern in ALLOWED:
        allowed = allowed | run.rlike(pattern)
    return ~allowed & (peak_entropy(run) >= _threshold(run))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, base, added``: arrays of spans ``(start, place, end, kind, found)`` in order.

    A text without any trigger of a pattern skips that pattern; the results are the same.
    """
    slim = docs.select(docs[id_col].alias("doc_id"), F.coalesce(docs[text_col], F.lit("")).alias("text"))
    none, text = F.expr("array()").cast(f"array<{_SPAN}>"), F.col("text")
    value = lambda s: F.char_length(F.regexp_extract(s["found"], f"^{ASSIGN}$", 1)) >= ASSIGN_MIN
    found = slim.select(
        "doc_id",
        F.when(text.rlike(ASSIGN), spans(text, ASSIGN, "assign", value)).otherwise(none).alias("assign"),
        F.when(text.contains("AKIA"), spans(text, ACCESS, "access")).otherwise(none).alias("access"),
        F.when(text.rlike(HEX), spans(text, HEX, "hex")).otherwise(none).alias("hex"),
        F.when(text.rlike(CANDIDATE), spans(text, CANDIDATE, "entropy", _suspicious)).otherwise(none).alias("runs"),
    )
    base = F.array_sort(F.concat("assign", "access", "hex"))
    return found.select("doc_id", base.alias("base"), "runs").select("doc_id", "base", F.when(F.size("runs") > 0, _apart(F.col("base"), F.col("runs"))).otherwise(none).alias("added"))


def joined(array: Column | str) -> Column:
    """Spans as ``kind:start:end``, comma-joined."""
    return F.array_join(F.transform(array, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def count_kind(array: str, kind: str) -> Column:
    return F.size(F.filter(array, lambda s: s["kind"] == kind)).cast("long")
