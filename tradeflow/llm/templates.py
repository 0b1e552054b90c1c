"""Benchmark decontamination by template canonicalisation, with DataFrame functions only.

Names (capitalised words), numbers and units become typed placeholders, punctuation and case go, and windows of
``WIDTH`` words are hash-joined between documents and benchmark items in up to three forms: word for word; with
numbers, units and names after a lower-case word as placeholders; and with all capitalised words as placeholders. A
form is only made where it differs from the one before it and leaves at least ``LITERALS`` literal words, so lists of
numbers or names match by their own values only. A name is the same placeholder in either form, so one at the start of a
sentence meets one inside.

Along one alignment (document position minus item position) the slots of one form's matching windows (the
later form of the two sides) must be consistent: one slot value of the item always stands for one value in the document. Inconsistent ones don't count.
A document holds an item if at least ``COVERAGE`` of the item's windows are found around one alignment, at most ``DRIFT``
words away from it (for small insertions); ``exact`` tells copies from re-parameterised versions.

Every word is hashed once; windows and slots are made of these numbers.

Defined cases: null and empty texts have no windows; an item of fewer than ``WIDTH`` words is one window of its
own width; an item without words is never found; items with equal texts are all found; rows are judged one by one,
also those that share an id or have a null id (equal texts give equal rows), and an id is reported with its best row;
extra columns are left out; empty tables give empty tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WIDTH, COVERAGE, LITERALS, DRIFT = 5, 0.8, 2, 2
#: Benchmark windows up to which their table is broadcast (about 100 bytes each); larger ones are joined by a shuffle.
MAX_BROADCAST = 500_000
MARK = "\u0001"
#: Low bits of a word's code: a placeholder, a capitalised word that does not follow a lower-case one, and two bits of type.
SLOT, CAPITAL, FLAGS = 1, 2, 16
#: Flags of the types of placeholders that ``template_words`` writes. Both kinds of names are of one type.
TYPES = {"a": SLOT, "c": SLOT | CAPITAL, "n": SLOT | 4, "u": SLOT | 8}
#: Forms of a window: no placeholders; names after a lower-case word, numbers and units; all names too.
FORMS = 3

# Units after a number.
UNITS = (
    "mm cm m km in ft yd mi mg g kg t oz lb ml l gal s sec min h hr hrs ms day days week weeks month months year years hour hours minute minutes "
    "second seconds meter meters metre metres mile miles gram grams kilogram kilograms liter liters litre litres dollar dollars euro euros cent "
    "cents percent mph kmh kph kw kwh w v hz khz mhz ghz kb mb gb tb inch inches foot feet pound pounds"
).split()


def template_words(text: Column) -> Column:
    """Words of the canonical text; a placeholder word is ``MARK``, its type and the value it stands for.

    Types are a (capitalised after a lower-case word), c (capitalised elsewhere), n (number) and u (unit after a number).
    """
    units = "|".join(sorted(UNITS, key=len, reverse=True))
    text = F.replace(F.coalesce(text, F.lit("")), F.lit(MARK), F.lit(" "))
    named = F.regexp_replace(text, r"(?<=\p{Ll} )(?=\p{Lu}\p{Ll})", f"{MARK}a")
    named = F.regexp_replace(named, r"(?<!\S)(?=[\p{P}\p{S}]*\p{Lu}\p{Ll})", f"{MARK}c")
    plain = F.regexp_replace(F.lower(named), r"[!-/:-@\[-`{-~]+", "")
    split_units = F.regexp_replace(plain, rf"(?<!\S)([0-9]+)({units})(?!\S)", "$1 $2")
    numbered = F.regexp_replace(split_units, r"(?<!\S)([0-9]+)(?!\S)", f"{MARK}n$1")
    valued = F.regexp_replace(numbered, rf"(?<={MARK}n[0-9]{{1,20}}\s)(?:{MARK}c)?({units})(?!\S)", f"{MARK}u$1")
    done = F.when(text.rlike("[0-9]"), valued).otherwise(plain)
    return F.split(F.btrim(done, F.lit(" \t\n\r\f\x0b")), r"\s+")  # one empty word if there is none


def word_codes(text: Column) -> Column:
    """A number for every template word: a hash of the literal word, with the flags of its placeholder in the lowest four bits."""
    def code(w: Column) -> Column:
        slot = F.ascii(F.translate(F.substring(w, 2, 1), "acnu", "".join(chr(64 + TYPES[k]) for k in "acnu"))) - 64
        return F.when(w.startswith(MARK), _literal(F.xxhash64(F.substring(w, 3, 2**31 - 1))).bitwiseOR(slot.cast("long"))).otherwise(_literal(F.xxhash64(w)))

    return F.transform(template_words(text), code)


def _bits(code: Column, mask: int) -> Column:
    return code.bitwiseAND(F.lit(mask).cast("long"))


def _literal(code: Column) -> Column:
    return _bits(code, -FLAGS)


def _typed(code: Column) -> Column:
    """A placeholder without its word; never a multiple of ``FLAGS``, as literal words are."""
    return _bits(code, FLAGS - 1 - CAPITAL)


def _form_hashes(words: list[Column], slots: Column, capitals: Column) -> list[Column]:
    """The hash of a window in each form; null if the form is that of another one or leaves too few literal words."""
    size = len(words)
    plain = [F.when(_bits(w, SLOT | CAPITAL) == SLOT, _typed(w)).otherwise(_literal(w)) for w in words]
    every = [F.when(_bits(w, SLOT) == SLOT, _typed(w)).otherwise(w) for w in words]
    return [
        F.xxhash64(*[_literal(w) for w in words]),
        F.when((slots > capitals) & (size - slots + capitals >= LITERALS), F.xxhash64(*plain)),
        F.when((capitals > 0) & (size - slots >= LITERALS), F.xxhash64(*every)),
    ]


def windows(rows: DataFrame, keys: list[str], text_col: str, sizes: list[int]) -> DataFrame:
    """``keys, n_words, place, form, size, hash, w0, w1, ...`` of all windows of ``sizes`` (ascending) words in their forms.

    ``w0`` and on are the codes of the words from the place on. Windows are made by zipping the code array with itself, so
    that hashing and joining run in compiled code on numbers; steps are kept small enough for the JIT compiler.
    """
    width = max(sizes)  # the last one
    words = rows.select(*keys, word_codes(rows[text_col]).alias("codes"))
    n = F.when(F.col("codes")[0] == _literal(F.xxhash64(F.lit(""))), 0).otherwise(F.size("codes"))  # one empty word if there is none
    counted = words.select(*keys, "codes", n.alias("n_words")).withColumn("count", F.greatest(F.col("n_words") - (min(sizes) - 1), F.lit(0)))
    names = [f"w{k}" for k in range(width)]
    zipped = F.arrays_zip(*[F.slice("codes", F.lit(k + 1), F.col("count")).alias(name) for k, name in enumerate(names)])
    found = counted.select(*keys, "n_words", F.posexplode(zipped).alias("place", "w")).select(*keys, "n_words", "place", *[F.col("w")[name].alias(name) for name in names])

    def flagged(size: int, flag: int) -> Column:
        """Words of the window with a flag."""
        return sum((F.coalesce(_bits(F.col(name), flag), F.lit(0)) for name in names[1:size]), F.coalesce(_bits(F.col(names[0]), flag), F.lit(0))) / flag

    for size in sizes:
        found = found.withColumns({f"slots{size}": flagged(size, SLOT).cast("int"), f"capitals{size}": flagged(size, CAPITAL).cast("int")})
    hashes = []
    for size in sizes:
        there = F.col(names[size - 1]).isNotNull()
        hashes += [F.when(there, h) for h in _form_hashes([F.col(name) for name in names[:size]], F.col(f"slots{size}"), F.col(f"capitals{size}"))]
    plain = F.when(F.col(f"slots{width}") > 0, F.array(*hashes)).otherwise(F.array(*[h if k % FORMS == 0 else F.lit(None).cast("long") for k, h in enumerate(hashes)]))
    every = found.select(*keys, "n_words", "place", *names, F.posexplode(plain).alias("at", "hash")).filter(F.col("hash").isNotNull())
    size = F.element_at(F.array(*map(F.lit, sizes)), F.floor(F.col("at") / FORMS).cast("int") + 1)
    return every.select(*keys, "n_words", "place", (F.col("at") % FORMS).alias("form"), size.alias("size"), "hash", *names)


def slot_values(width: int) -> Column:
    """The codes of a window's words that its form makes placeholders, in order; names have one type."""
    words = F.slice(F.array(*[F.col(f"w{k}") for k in range(width)]), F.lit(1), F.col("size"))
    kept = F.filter(words, lambda w: (_bits(w, SLOT) == SLOT) & ((F.col("form") == 2) | ((F.col("form") == 1) & (_bits(w, CAPITAL) == 0))))
    return F.transform(kept, lambda w: _bits(w, ~CAPITAL))


def contaminated(docs: DataFrame, benchmark: DataFrame, width: int = WIDTH, coverage: float = COVERAGE, max_broadcast: int = MAX_BROADCAST) -> DataFrame:
    """``doc_id, item_id, n_windows, n_found, coverage, exact`` of every document that holds an item.

    ``docs`` has ``doc_id, text``, ``benchmark`` ``item_id, text``.
    """
    words = template_words(benchmark["text"])
    lengths = benchmark.select(F.when(words[0] != "", F.size(words)).otherwise(0).alias("n"))
    short = [r["n"] for r in lengths.filter((F.col("n") > 0) & (F.col("n") < width)).distinct().collect()]  # fewer than ``width`` values
    sizes = [*sorted(short), width]
    own_size = F.col("size") == F.least("n_words", F.lit(width))
    items = windows(benchmark.select("item_id", "text"), ["item_id"], "text", sizes).filter(own_size).select(
        "item_id", (F.col("n_words") - F.col("size") + 1).alias("n_windows"), F.col("place").alias("item_place"), F.col("form").alias("item_form"), F.col("hash").alias("item_hash"), slot_values(width).alias("item_slots")
    )
    if items.count() <= max_broadcast:
        items = F.broadcast(items)
    # A row is told by its id and text.
    told = docs.select("doc_id", F.xxhash64("text").alias("row"), "text")
    hits = windows(told, ["doc_id", "row"], "text", sizes).join(items, F.col("hash") == F.col("item_hash"))
    slim = hits.select("doc_id", "row", "item_id", "n_windows", "item_place", F.greatest("form", "item_form").alias("level"), (F.col("place") - F.col("item_place")).alias("shift"), slot_values(width).alias("slots"), "item_slots")
    # One exchange by row and item serves all aggregations; rows are hits only, not windows.
    pair = ["doc_id", "row", "item_id", "n_windows"]
    slots = F.array_distinct(F.flatten(F.collect_list(F.arrays_zip(F.col("item_slots").alias("old"), F.col("slots").alias("new")))))
    lines = slim.repartition("doc_id", "row", "item_id").groupBy(*pair, "shift", "level").agg(F.collect_set("item_place").alias("places"), slots.alias("pairs"))
    consistent = F.size(F.array_distinct(F.transform("pairs", lambda p: p["old"]))) == F.size("pairs")
    same = F.forall("pairs", lambda p: p["old"] == p["new"])
    near = F.explode(F.sequence(F.col("shift") - DRIFT, F.col("shift") + DRIFT))
    placed = lines.filter(consistent).select(*pair, near.alias("centre"), "places", F.when(same, F.col("places")).alias("copied"))
    count = lambda name: F.size(F.array_distinct(F.flatten(F.collect_list(name))))
    around = placed.groupBy(*pair, "centre").agg(count("places").alias("n_found"), count("copied").alias("n_copied"))
    best = around.groupBy("doc_id", "item_id", "n_windows").agg(F.max(F.struct("n_found", "n_copied")).alias("best"))
    share = F.col("best.n_found") / F.col("n_windows")
    found = best.select("doc_id", "item_id", F.col("n_windows").cast("long"), F.col("best.n_found").cast("long").alias("n_found"), share.alias("coverage"), (F.col("best.n_copied") == F.col("best.n_found")).alias("exact"))
    return found.filter(F.col("coverage") >= coverage)
