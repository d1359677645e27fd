"""Personal data [native]: fixed patterns, and terms that give protected entities away by their co-occurrence."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from episodica.sources.shared import store

KINDS = ("email", "ip", "card", "phone", "term")
# The base patterns.  Loops that can't give anything back are possessive, and a match starts at the head of its run
# or where the last match ended: the same matches, in time and stack space that don't grow with a run's square.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
NEEDS = {"email": "@", "ip": ".", "phone": "+"}  # a text without it has no match
BYTE_PART = "^0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])$"
TERM = r"\p{L}{4,}"
PIECE = 256  # characters of a text in which terms are located at a time
RUN = 256  # matches located at a time
SPAN = "struct<start:int,kind:int,stop:int,value:string>"


def bound(value: Column, use) -> Column:
    """``use(value)`` with the value computed once, also where it stands inside a lambda."""
    return F.element_at(F.transform(F.array(value), use), 1)


def located(text: Column, pattern: str, kind: int) -> Column:
    """All matches as structs (start, kind, stop, value): starts are sums of the lengths of what lies between and of the matches.

    Matches are taken in runs of 256: sums of runs give where each begins, so that no array grows match by match.
    """
    found, between = F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.split(text, pattern, -1)
    pairs = F.arrays_zip(F.slice(between, F.lit(1), F.size(found)).alias("gap"), found.alias("hit"))
    nothing = F.array().cast(f"array<{SPAN}>")

    def add(done, pair):
        start = F.element_at(done, -1)["stop"] + F.length(pair["gap"])
        one = F.struct(start.alias("start"), F.lit(kind).alias("kind"), (start + F.length(pair["hit"])).alias("stop"), pair["hit"].alias("value"))
        return F.concat(done, F.array(one.cast(SPAN)))

    def spans_of(run, offset):
        """The spans of one run; a first element that only holds the offset is left out again."""
        head = F.struct(F.lit(0).alias("start"), F.lit(kind).alias("kind"), offset.alias("stop"), F.lit("").alias("value")).cast(SPAN)
        return F.slice(F.aggregate(run, F.array(head), add), F.lit(2), F.size(run))

    def runs_of(all_pairs):
        return F.transform(F.sequence(F.lit(1), F.size(all_pairs), F.lit(RUN)), lambda at: F.slice(all_pairs, at, F.lit(RUN)))

    def length_of(run):
        return F.aggregate(run, F.lit(0), lambda n, pair: n + F.length(pair["gap"]) + F.length(pair["hit"]))

    def offsets_of(runs):
        return F.aggregate(runs, F.array(F.lit(0)), lambda done, run: F.concat(done, F.array(F.element_at(done, -1) + length_of(run))))

    def all_spans(runs):
        return bound(offsets_of(runs), lambda offsets: F.flatten(F.transform(runs, lambda run, i: spans_of(run, F.get(offsets, i)))))

    pairs = pairs.cast("array<struct<gap:string,hit:string>>")
    return F.when(F.size(found) > 0, bound(pairs, lambda p: bound(runs_of(p), all_spans))).otherwise(nothing)


def luhn(digits: Column) -> Column:
    turned = F.reverse(digits)

    def add(total, i):
        d = F.substring(turned, i, F.lit(1)).cast("int")
        doubled = d * 2
        return total + F.when(i % 2 == 1, d).otherwise(F.when(doubled > 9, doubled - 9).otherwise(doubled))

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), add) % 10 == 0


def digits_of(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def valid(kind: str):
    """The check that a pattern's matches have to pass, on the span."""
    return lambda span: valid_value(kind, span["value"])


def valid_value(kind: str, value: Column) -> Column:
    if kind == "ip":
        return F.forall(F.split(value, r"\."), lambda part: part.rlike(BYTE_PART))
    if kind == "card":
        digits = digits_of(value)
        return F.when(F.length(digits).between(12, 19), luhn(digits)).otherwise(F.lit(False))
    if kind == "phone":
        return F.length(digits_of(value)).between(9, 15)
    return F.lit(True)


def entity(kind: Column, value: Column) -> Column:
    return F.concat_ws(":", kind.cast("string"), F.when(kind >= 2, digits_of(value)).otherwise(F.lower(value)))


def joined(spans: Column) -> Column:
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(F.array_sort(spans), lambda s: F.concat_ws(":", names[s["kind"]], s["start"], s["stop"])), ",")


def sanitised(text: Column, spans: Column) -> Column:
    """The text with every span replaced by its kind in brackets: a generalisation that keeps where something stood.

    Spans that overlap one before them only lengthen what is cut.
    """
    names = F.array(*map(F.lit, KINDS))
    begin = F.struct(F.lit("").alias("out"), F.lit(0).alias("at"))

    def add(done, s):
        apart = s["start"] >= done["at"]
        piece = F.concat(done["out"], F.substring(text, done["at"] + 1, s["start"] - done["at"]), F.lit("["), names[s["kind"]], F.lit("]"))
        return F.struct(F.when(apart, piece).otherwise(done["out"]).alias("out"), F.greatest(done["at"], s["stop"]).alias("at"))

    made = F.aggregate(F.array_sort(spans), begin, add)
    return F.concat(made["out"], F.substring(text, made["at"] + 1, F.length(text)))


def lowered(text: Column) -> Column:
    return F.transform(F.regexp_extract_all(text, F.lit(TERM), F.lit(0)), F.lower)


def surroundings_of_terms(docs: DataFrame, text: str, terms: DataFrame, around: int) -> DataFrame:
    """(term, context) of every occurrence of the ``terms`` in different texts; a context is the hash of what is ``around``.

    Only texts that hold one of the terms are looked at closely, copies of a text once.  They are cut into pieces of
    256 characters; what starts in a piece is located in the piece and its two neighbours.
    """
    texts = docs.select(F.xxhash64(text).alias("copy"), F.col(text).alias("_text"))
    holders = texts.select("copy", F.explode(F.array_distinct(lowered(F.col("_text")))).alias("term")).join(terms, "term", "left_semi").select("copy").distinct()
    held = texts.groupBy("copy").agg(F.min("_text").alias("_text")).join(holders, "copy", "left_semi")
    pieces = held.select(F.regexp_extract_all("_text", F.lit("(?s).{1,%d}" % PIECE), F.lit(0)).alias("all"))
    trio = F.transform("all", lambda p, k: F.struct(
        F.when(k > 0, F.get("all", k - 1)).otherwise(F.lit("")).alias("before"), p.alias("piece"), F.coalesce(F.get("all", k + 1), F.lit("")).alias("after"),
    ))
    pieces = pieces.select(F.explode(trio).alias("p")).select(F.concat("p.before", "p.piece", "p.after").alias("wide"), F.length("p.before").alias("low"), F.length("p.piece").alias("size"))
    # terms are located only where one of them is near
    pieces = pieces.select("*", F.explode(F.array_distinct(lowered(F.col("wide")))).alias("term")).join(terms, "term", "left_semi")
    found = pieces.select("term", "wide", "low", "size", F.explode(located(F.col("wide"), TERM, 4)).alias("t"))
    found = found.where((F.lower("t.value") == F.col("term")) & (F.col("t.start") >= F.col("low")) & (F.col("t.start") < F.col("low") + F.col("size")))
    return found.select("term", context(F.col("wide"), F.col("t.start"), F.col("t.stop"), around).alias("context"))


def context(text: Column, start: Column, stop: Column, around: int) -> Column:
    low = F.greatest(start - around, F.lit(0))
    return F.xxhash64(F.substring(text, low + 1, stop + around - low))


def find_personal_data(
    docs: DataFrame, keep: list[str], text: str = "text", around: int = 80, least_windows: int = 3, least_share: float = 0.5, least_bits: float = 6.0
) -> DataFrame:
    """Per row ``doc`` (struct of ``keep``), ``n_email``, ``n_ip``, ``n_card``, ``n_phone``, ``n_term``, ``base_sha256``, ``spans``, ``found``.

    The base spans are the valid matches of the fixed patterns (code points, end exclusive).  Each distinct value of
    one is a protected entity.  Terms are lower-cased words of four letters or more within ``around`` characters of
    an entity and outside base spans.  The corpus tells what a term gives away: of the windows around entities,
    different ones only (copies of a passage count once), ``least_windows`` must hold term and entity.  What is
    ``around`` an occurrence of a term is its context; n(t) different contexts hold the term, with the entity near it
    n(t, e) of them.  A term is reported near an entity if n(t, e) / n(t) reaches ``least_share``, and the
    term makes the entity 2 ** ``least_bits`` times likelier than it is in any window.

    ``sanitised`` replaces spans.  Counts are partial aggregates over all texts; nothing is collected.  Null and
    empty texts have no spans; repeated rows give repeated results; an empty table gives no rows.
    """
    body = F.coalesce(F.col("_text"), F.lit(""))
    frame = docs.select(F.struct(*[docs[c] for c in keep]).alias("doc"), F.col(text).alias("_text")).withColumn("_text", body)
    nothing = F.array().cast(f"array<{SPAN}>")
    each = []
    for number, (kind, pattern) in enumerate(PATTERNS.items()):
        hits = F.filter(located(F.col("_text"), pattern, number), valid(kind))
        each.append(F.when(F.contains("_text", F.lit(NEEDS[kind])), hits).otherwise(nothing) if kind in NEEDS else hits)
    frame = frame.withColumn("base", F.array_sort(F.concat(*each)))

    def window(s):
        low = F.greatest(s["start"] - around, F.lit(0))
        near = F.substring(F.col("_text"), low + 1, s["stop"] - low + around)
        back = F.greatest(s["start"] - 2 * around, F.lit(0))
        wide = F.substring(F.col("_text"), back + 1, s["stop"] - back + 2 * around)
        terms = F.filter(
            located(near, TERM, 4),
            lambda t: ~F.exists("base", lambda b: (b["start"] < t["stop"] + low) & (t["start"] + low < b["stop"])),
        )
        return F.struct(
            entity(s["kind"], s["value"]).alias("entity"), F.xxhash64(near).alias("window"),
            F.transform(terms, lambda t: F.struct((t["start"] + low).alias("start"), (t["stop"] + low).alias("stop"), F.lower(t["value"]).alias("term"),
                context(wide, t["start"] + low - back, t["stop"] + low - back, around).alias("context"))).alias("terms"),
        )

    rows = store(
        frame.select("doc", F.transform("base", lambda s: s.dropFields("value")).alias("base"), F.transform("base", window).alias("windows"))
        .withColumn("row", F.monotonically_increasing_id()), "personal",
    )
    windows = rows.select("row", F.explode("windows").alias("w")).select("row", "w.entity", "w.window", "w.terms")
    of_entity = windows.groupBy("entity").agg(F.count_distinct("window").alias("n_entity"))
    total = windows.select(F.count_distinct("entity", "window")).first()[0]
    near = windows.select("row", "entity", "window", F.explode("terms").alias("t")).select("row", "entity", "window", "t.term", "t.context", "t.start", "t.stop")
    both_near = near.groupBy("entity", "term").agg(F.count_distinct("window").alias("n_windows"), F.count_distinct("context").alias("n_both"))
    # no more than all contexts near entities can be those of one entity: this leaves out most common words
    of_near = near.groupBy("term").agg(F.count_distinct("context").alias("n_near"))
    together = store(
        both_near.where(F.col("n_windows") >= least_windows).join(of_near, "term").where(F.col("n_both") / F.col("n_near") >= least_share).drop("n_near"), "together"
    )
    if together.isEmpty():
        revealed = None
    else:
        of_term = surroundings_of_terms(docs, text, together.select("term").distinct(), around).groupBy("term").agg(F.count_distinct("context").alias("n_term"))
        share = F.least(F.col("n_both") / F.col("n_term"), F.lit(1.0))
        told = together.join(of_term, "term").join(of_entity, "entity").where(
            (share >= least_share) & (F.log2(share * F.lit(float(total)) / F.col("n_entity")) >= least_bits)
        )
        told = store(told.select("entity", "term"), "revealing")
        spans = near.join(told, ["entity", "term"]).select("row", F.struct("start", F.lit(4).alias("kind"), "stop").alias("s")).distinct()
        revealed = spans.groupBy("row").agg(F.collect_list("s").alias("terms"))
    none = F.array().cast("array<struct<start:int,kind:int,stop:int>>")
    if revealed is None:
        both = rows.withColumn("terms", none)
    else:
        both = rows.join(revealed, "row", "left").withColumn("terms", F.coalesce("terms", none))
    found = F.array_sort(F.concat("base", "terms"))

    def count(kind):
        return F.size(F.filter("found", lambda s: s["kind"] == KINDS.index(kind))).cast("long").alias(f"n_{kind}")

    return both.withColumn("found", found).select(
        "doc", *[count(k) for k in KINDS], F.sha2(joined(F.col("base")).cast("binary"), 256).alias("base_sha256"), joined(F.col("found")).alias("spans"), "found",
    )
