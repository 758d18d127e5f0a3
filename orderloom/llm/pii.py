"""Personal data by bootstrapped contextual extraction, in DataFrame operations only.

Regular expressions find the seed entities. The words around them, in several forms, are lexical
patterns; a graph joins patterns to the instances seen in them, over all identifier-like words of
the corpus.
Rounds of scoring weigh patterns by the share of their instances already known to be of one
kind, and instances by the patterns that hold them; instances scored high enough and of
plausible form become known and count in the next round, until a round finds none. Every
occurrence of a known instance, seeds included, that is no seed itself is added to the spans;
seeds always stay.

Identifiers may be written with blanks: beside single words, runs of digit groups that hold a blank
and have the form of a kind are candidates. Of added spans of a kind in a row, those inside
another are left out.

Places are code points, ends exclusive. Defined results: a null text counts as empty and has no
entity; an id may be null or repeated: every input row gives one output row, and no rows give none.
Other columns have no effect.
"""

from __future__ import annotations

from functools import reduce
from itertools import count

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderloom.llm.common import attach, stored

# The kinds, their order and their forms. The quantifiers are possessive and the
# starts anchored where that leaves the matches as they are, so that no text takes squared time.
KINDS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){12,18}+(?![\x20-]?[0-9])",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# Identifier-like words: those with a digit or an at sign.
CANDIDATE = r"(?<!\S)[^\s0-9@]*+[0-9@]\S*+"
# Groups of digits joined by single blanks, hyphens, dots or brackets, a bracket also beside one of
# the others; a group ends before a letter, and a run begins behind none.
_GROUP = r"[0-9]++(?![\p{L}@])"
RUN = rf"(?<![\p{{L}}\p{{N}}@+])(?:\((?=[0-9]++\)))?{_GROUP}(?:(?:[\x20.-]\(?|\([\x20.-]?|\)[\x20.-]?){_GROUP})++"
# Forms that a discovered instance of a kind must have; a card passes Luhn too.
PLAUSIBLE = {
    "email": r"^\S+(@|\(at\)|\[at\])\S+$",
    "ip": r"^([0-9]{1,3}[._-]){3}[0-9]{1,3}$|^[0-9A-Fa-f]{0,4}(:[0-9A-Fa-f]{0,4}){3,7}$",
    "card": r"^([0-9][ ._-]?){12,18}[0-9]$",
    "phone": r"^[(]?([0-9][ ()._-]{0,2}){6,14}[0-9]$",
}
CONTEXT = 60
BLOCK = 256
# Code points of a piece of a text, from which contexts are cut; at least CONTEXT.
PIECE = 256
SUPPORT = 3
CONFIDENCE = 0.7
UNKNOWN = 0.25
# Pairs of words and seeds that are compared in place.
PAIRS = 1_000_000

_SPAN = "struct<start:bigint,end:bigint,value:string>"


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""
    turned = F.reverse(digits)

    def add(acc: Column, i: Column) -> Column:
        d = F.substr(turned, i, F.lit(1)).cast("int") * F.when(i % 2 == 0, 2).otherwise(1)
        return acc + F.when(d > 9, d - 9).otherwise(d)

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), add) % 10 == 0


def _holds(kind: str, value: Column) -> Column:
    digits = _digits(value)
    if kind == "ip":
        parts = F.transform(F.split(value, r"\."), lambda p: F.regexp_replace(p, "^0+(?=[0-9])", ""))
        return F.forall(parts, lambda p: (F.length(p) <= 3) & (F.try_to_number(p, F.lit("999")) <= 255))
    if kind == "card":
        return F.length(digits).between(13, 19) & luhn(digits)
    if kind == "phone":
        return F.length(digits).between(9, 15)
    return F.lit(True)


def _checker(kind: str):
    return lambda span: _holds(kind, span["value"])


def _named(kind: str, place: int):
    """Turns spans of a kind into structs that sort by kind, then start."""
    return lambda s: F.struct(
        F.lit(place).cast("long").alias("place"), s["start"].alias("start"), s["end"].alias("end"),
        F.lit(kind).alias("kind"),
    )


def _places(found: Column, gaps: Column) -> Column:
    """Spans of the matches ``found`` between the pieces ``gaps`` of a text.

    The array grows by blocks, as every append copies it.
    """
    none = F.array().cast(f"array<{_SPAN}>")

    def step(acc: Column, i: Column) -> Column:
        value, gap = F.get(found, i), F.get(gaps, i)
        begin = acc["at"] + F.length(gap)
        end = begin + F.length(value)
        one = F.struct(begin.alias("start"), end.alias("end"), value.alias("value")).cast(_SPAN)
        return F.struct(end.alias("at"), F.concat(acc["out"], F.array(one)).alias("out"))

    def block(acc: Column, number: Column) -> Column:
        own = F.sequence(number * BLOCK, F.least((number + 1) * BLOCK, F.size(found)) - 1)
        start = F.struct(acc["at"].alias("at"), none.alias("out"))
        return F.aggregate(
            own, start, step, lambda x: F.struct(x["at"].alias("at"), F.concat(acc["out"], x["out"]).alias("out"))
        )

    blocks = F.sequence(F.lit(0), F.floor((F.size(found) - 1) / BLOCK).cast("int"))
    start = F.struct(F.lit(0).cast("long").alias("at"), none.alias("out"))
    return F.when(F.size(found) > 0, F.aggregate(blocks, start, block, lambda acc: acc["out"])).otherwise(none)


def _in_context(pieces: Column, marked: bool):
    """Turns spans into start, end, at, core, left and right: the identifier, its place and what is around it.

    The marks around a word (``marked``) are no part of the identifier; a run has none. The sides
    are cut from the whole text around the identifier, of seeds and of candidates alike.
    """

    def piece(number: Column) -> Column:
        return F.coalesce(F.get(pieces, number.cast("int")), F.lit(""))

    def add(span: Column) -> Column:
        value, lead, core = span["value"], F.lit(0), span["value"]
        if marked:
            word = ~F.contains(value, F.lit(" "))
            lead = F.when(word, F.length(F.regexp_extract(value, r"^[^\p{L}\p{N}+]*+", 0))).otherwise(0)
            core = F.when(
                word, F.regexp_replace(value, r"^[^\p{L}\p{N}+]++|(?<=[\p{L}\p{N}])[^\p{L}\p{N}]++$", "")
            ).otherwise(value)
        at = span["start"] + lead
        stop = at + F.length(core)
        here, there = F.floor(at / PIECE), F.floor(stop / PIECE)
        left = F.concat(piece(here - 1), F.substring(piece(here), F.lit(1), (at % PIECE).cast("int")))
        right = F.concat(piece(there), piece(there + 1))
        return F.struct(
            span["start"].alias("start"), span["end"].alias("end"), at.alias("at"), core.alias("core"),
            F.substring(left, -CONTEXT, CONTEXT).alias("left"),
            F.substring(right, (stop % PIECE + 1).cast("int"), F.lit(CONTEXT)).alias("right"),
        )

    return add


def seeds(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: row (a number), doc_id, spans of each kind, and ``others`` (identifier-like words and runs)."""
    rows = docs.select(
        F.col(id_col).alias("doc_id"),
        F.monotonically_increasing_id().alias("row"),
        F.coalesce(F.col(text), F.lit("")).alias("t"),
    )
    none = F.array().cast("array<string>")
    has_digit, has_at, has_plus = F.col("t").rlike("[0-9]"), F.contains("t", F.lit("@")), F.contains("t", F.lit("+"))
    asked = {"email": has_at, "ip": has_digit, "card": has_digit, "phone": has_plus & has_digit,
             "others": has_at | has_digit}
    asked["runs"] = has_digit
    forms = {**KINDS, "others": CANDIDATE, "runs": RUN}
    for kind, form in forms.items():
        rows = rows.withColumn(
            f"{kind}_found", F.when(asked[kind], F.regexp_extract_all("t", F.lit(form), F.lit(0))).otherwise(none)
        )
    for kind, form in forms.items():
        some = F.size(f"{kind}_found") > 0
        rows = rows.withColumn(f"{kind}_gaps", F.when(some, F.split("t", form, -1)).otherwise(none))
    for kind in forms:
        rows = rows.withColumn(kind, _places(F.col(f"{kind}_found"), F.col(f"{kind}_gaps")))
    for kind in KINDS:
        rows = rows.withColumn(kind, F.filter(kind, _checker(kind)))
    # A run without a blank is in a word.
    wide = F.filter("runs", lambda s: F.contains(s["value"], F.lit(" ")) & _formed(s["value"]))
    rows = rows.withColumn("others", F.concat("others", wide))
    found = reduce(lambda a, b: a | b, [F.size(c) > 0 for c in (*KINDS, "others")])
    pieces = F.regexp_extract_all("t", F.lit(f"(?s).{{1,{PIECE}}}"), F.lit(0))
    rows = rows.withColumn("pieces", F.when(found, pieces).otherwise(none))
    return rows.select(
        "row", "doc_id",
        *[F.transform(c, _in_context(F.col("pieces"), c == "others")).alias(c) for c in (*KINDS, "others")],
    )


def _formed(value: Column) -> Column:
    """Whether a value has the form of any kind."""
    return reduce(lambda a, b: a | b, [value.rlike(form) for form in PLAUSIBLE.values()])


def _shape(value: Column) -> Column:
    """An identifier with each run of digits as 9 and each run of letters as a."""
    return F.regexp_replace(F.regexp_replace(value, "[0-9]+", "9"), r"\p{L}+", "a")


def _patterns(left: Column, right: Column, value: Column) -> Column:
    """Lexical patterns of an occurrence, from the words around it: on both sides, on the left
    alone, over gaps of one and two words (a name, say), and with the identifier's shape.

    Words count without their marks, so that "phone:" is "phone".
    """

    def words(side: Column) -> Column:
        found = F.regexp_extract_all(F.lower(side), F.lit(r"\S+"), F.lit(0))
        return F.filter(F.transform(found, lambda w: F.regexp_replace(w, r"[^\p{L}\p{N}]+", "")), lambda w: w != "")

    before, after = words(left), words(right)
    one, two, three, four = [F.coalesce(F.try_element_at(before, F.lit(-n)), F.lit("^")) for n in range(1, 5)]
    next_one = F.coalesce(F.try_element_at(after, F.lit(1)), F.lit("$"))
    place, gap = F.lit("_"), F.lit("*")
    forms = [
        (two, one, place),
        (one, place, next_one),
        (two, one, place, next_one),
        (one, place),
        (one, place, F.lit("like"), _shape(value)),
        (three, gap, one, place),
        (four, gap, gap, one, place),
        (three, two, gap, place),
        (four, three, gap, gap, place),
    ]
    return F.array(*[F.concat_ws(" ", *form) for form in forms])


def _overlaps(span: Column) -> Column:
    hit = [F.exists(k, lambda s: (s["start"] < span["end"]) & (s["end"] > span["start"])) for k in KINDS]
    return reduce(lambda a, b: a | b, hit)


def _seeds_of(found: DataFrame) -> DataFrame:
    parts = [found.select("row", F.lit(k).alias("kind"), F.explode(k).alias("s")) for k in KINDS]
    return reduce(DataFrame.unionByName, parts)


def _free_words(found: DataFrame) -> DataFrame:
    """Identifier-like words that overlap no seed of their row: row, s.

    Words and seeds of a row are compared in place. Where there are many of both, they are
    instead passed over once in the order of their places; the words are the same.
    """
    seeds_in_row = reduce(lambda a, b: a + b, [F.size(k).cast("long") for k in KINDS])
    many = seeds_in_row * F.size("others") > PAIRS
    few = found.filter(~many)
    near = few.select("row", F.explode(F.filter("others", lambda s: ~_overlaps(s))).alias("s"))
    rest = found.filter(many)
    words = rest.select("row", F.lit(None).cast("string").alias("kind"), F.explode("others").alias("s"))
    every = _seeds_of(rest).unionByName(words)
    seed = F.col("kind").isNotNull()
    # At one place seeds come first, so that all seeds that begin at or before a word precede it.
    order = Window.partitionBy("row").orderBy("s.start", F.col("kind").isNull())
    ends = F.max(F.when(seed, F.col("s.end"))).over(order.rowsBetween(Window.unboundedPreceding, 0))
    starts = F.min(F.when(seed, F.col("s.start"))).over(order.rowsBetween(1, Window.unboundedFollowing))
    marked = every.withColumn("ends", ends).withColumn("starts", starts).filter(~seed)
    clear = (F.coalesce("ends", F.lit(-1)) <= F.col("s.start")) & (F.coalesce("starts", "s.end") >= F.col("s.end"))
    return near.unionByName(marked.filter(clear).select("row", "s"))


def occurrences(found: DataFrame) -> DataFrame:
    """Every seed, and every identifier-like word that overlaps none: row, start, end, value, kind, patterns."""
    every = _seeds_of(found).unionByName(
        _free_words(found).select("row", F.lit(None).cast("string").alias("kind"), "s")
    )
    start = F.col("s.at")
    return every.select(
        "row", "kind", start.alias("start"), (start + F.length("s.core")).alias("end"),
        F.lower("s.core").alias("value"), _patterns(F.col("s.left"), F.col("s.right"), F.col("s.core")).alias("patterns"),
    ).filter("value <> ''")


def _plausible(kind: Column, value: Column) -> Column:
    checks = [
        (kind == k) & value.rlike(form) & (luhn(_digits(value)) if k == "card" else F.lit(True))
        for k, form in PLAUSIBLE.items()
    ]
    return reduce(lambda a, b: a | b, checks)


def discover(
    found: DataFrame, rounds: int | None = None, support: int = SUPPORT, confidence: float = CONFIDENCE
) -> DataFrame:
    """Known instances (value, kind), seeds among them, of the stored occurrences ``found``.

    Rounds go on until one finds nothing new, or number ``rounds``.

    A pattern's confidence in a kind is known / (known + other + UNKNOWN * unknown), over its
    distinct instances, where other are those known of another kind; it needs ``support`` known
    ones. An instance's score is 1 - prod(1 - confidence) over its confident patterns.
    """
    edges = stored(
        found.select("value", "kind", F.explode("patterns").alias("pattern"))
        .groupBy("pattern", "value")
        .agg(F.max("kind").alias("kind")),
        "edges",
    )
    total = edges.count()

    def marked(new: DataFrame) -> DataFrame:
        """The edges, those of the values of ``new`` (value, new, n) known."""
        return stored(
            attach(edges, new, "value", "n", total, "left").select(
                "pattern", "value", F.coalesce("kind", "new").alias("kind")
            ),
            "edges",
        )

    # The value of a seed is known in all its occurrences.
    values = edges.groupBy("value").agg(F.max("kind").alias("new"), F.count(F.lit(1)).alias("n"))
    edges = marked(stored(values.filter("new is not null"), "seed_instances"))
    for _ in count() if rounds is None else range(rounds):
        sums = edges.groupBy("pattern").agg(
            *[F.count(F.when(F.col("kind") == k, 1)).alias(k) for k in KINDS],
            F.count(F.lit(1)).alias("n"),
        )
        known = reduce(lambda a, b: a + b, [F.col(k) for k in KINDS])
        rated = sums.select(
            "pattern", "n",
            F.explode(F.array(*[F.struct(F.lit(k).alias("kind"), F.col(k).alias("pos")) for k in KINDS])).alias("k"),
            (known + UNKNOWN * (F.col("n") - known)).alias("all"),
        ).select("pattern", "n", F.col("k.kind").alias("of"), F.col("k.pos").alias("pos"),
                 (F.col("k.pos") / F.col("all")).alias("c"))
        # At most one kind can pass half, so that a pattern keeps one row.
        good = stored(
            rated.filter((F.col("pos") >= support) & (F.col("c") >= max(confidence, 0.51)))
            .select("pattern", "n", "of", "c"),
            "good_patterns",
        )
        open_edges = edges.filter("kind is null").select("pattern", "value")
        reached = attach(open_edges, good, "pattern", "n", total)
        scored = reached.groupBy("value", "of").agg(
            (1 - F.exp(F.sum(F.log(F.greatest(1 - F.col("c"), F.lit(1e-6)))))).alias("score")
        )
        best = scored.groupBy("value").agg(
            F.max(F.struct("score", "of")).alias("b")
        ).select("value", "b.score", F.col("b.of").alias("new"))
        best = best.filter((F.col("score") >= confidence) & _plausible(F.col("new"), F.col("value")))
        degrees = edges.filter("kind is null").groupBy("value").agg(F.count(F.lit(1)).alias("n"))
        new = stored(best.join(degrees, "value").select("value", "new", "n"), "new_instances")
        if new.isEmpty():
            break
        edges = marked(new)
    return edges.filter("kind is not null").groupBy("value").agg(F.max("kind").alias("kind"))


def find_pii(
    docs: DataFrame, rounds: int | None = None, id_col: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Per row of ``docs``: doc_id, base and added (arrays of kind, start, end), by kind, then start."""
    found = stored(seeds(docs, id_col, text), "pii_seeds")
    every = stored(occurrences(found), "pii_occurrences")
    instances = discover(every, rounds)
    open_ones = every.filter("kind is null").select("row", "start", "end", "value")
    counts = open_ones.groupBy("value").agg(F.count(F.lit(1)).alias("n"))
    wanted = stored(instances.join(counts, "value"), "pii_instances")
    hits = attach(open_ones, wanted, "value", "n", open_ones.count())
    # A span inside another of its kind; the longest of those at one start comes first.
    before = Window.partitionBy("row", "kind").orderBy("start", F.desc("end")).rowsBetween(
        Window.unboundedPreceding, -1
    )
    hits = hits.withColumn("reach", F.max("end").over(before)).filter("reach is null or reach < end")
    order = F.array_position(F.array(*[F.lit(k) for k in KINDS]), F.col("kind"))
    added = hits.groupBy("row").agg(
        F.array_sort(F.collect_list(F.struct(order.alias("place"), "start", "end", "kind"))).alias("more")
    )
    base = F.concat(*[F.transform(k, _named(k, i)) for i, k in enumerate(KINDS, 1)])
    return found.select("row", "doc_id", base.alias("base")).join(added, "row", "left").select(
        "doc_id", "base", F.coalesce("more", F.expr("slice(base, 1, 0)")).alias("added")
    )


def digest(spans: Column) -> Column:
    """kind:start:end of all spans, by kind, then start, comma-joined."""
    return F.concat_ws(
        ",", F.transform(F.array_sort(spans), lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"]))
    )


def counted(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")
