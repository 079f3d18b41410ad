"""Personal data by bootstrapped contextual extraction, without Python.

Base entities (mail addresses, IP addresses, card and phone numbers) and tokens that look like keys (letters and
digits that take turns) seed a graph of patterns and instances, the identifier-like tokens. A place gives several
patterns: the one or two words before the token, with labels and punctuation kept and digits as #; the word
before together with the word after, or with the token's shape; and the shape alone. Scores flow between both
sides: a pattern is as good as its instances, an instance as likely as the best form of pattern that holds it makes
it. An instance of high likelihood supports further patterns in the next generation, which are scored with
the others, until no new instance is found. Tokens under lexical patterns of high confidence are added as entities of
the pattern's kind; what looks like a key is a ``secret`` only there, and a shape alone adds nothing.

Cases: a null text is empty and has no entity; rows are read one by one, so repeated rows and null ids get
their own spans; an empty table gives no rows; other columns are not read. Patterns need several distinct
seeds or found instances, so a corpus without such contexts adds nothing. A context that runs over 64
characters without a blank is none; tokens of fewer than 6 characters are not added.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from splitsight.session import stored

KINDS = ("email", "ip", "card", "phone")
# Found by the method only, after the base kinds in order.
MORE_KINDS = ("secret",)

# Each begins only where a leftmost search would begin: after the last match, or where what goes before
# can't belong to the match. Possessive repetition keeps them linear on texts of any length.
EMAIL = r"(?=[A-Za-z0-9._%+-])(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?=[0-9])(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
# A whole run of digits with single blanks or hyphens between them, 16 to 19 digits long.
CARD = r"(?=[0-9])(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){15,18}+(?![\x20-]?[0-9])"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
# A token with a digit or an at-sign.
IDENTIFIER = r"(?<!\S)[^\s0-9@]*+[0-9@]\S*+"
# Letters and digits that take turns four times, 16 characters at least.
KEY = r"^(?=[A-Za-z0-9+/_=-]{16,}+$)[A-Za-z+/_=-]*+(?:[0-9]++[A-Za-z+/_=-]++){4}"
# Not part of an identifier at its ends.
AROUND = """.,;:!?"'`()[]{}<>|*%$#&~"""
LONGEST_CONTEXT, SHORTEST_FOUND = 64, 6

MIN_SEEDS = 3
CONFIDENCE = 0.8
ROUNDS = 3


def _places(text: Column, pattern: str, when: Column | None = None) -> Column:
    """Matches of a pattern: array of (start, end, value, before), in characters.

    The pieces between the matches give the starts.
    """
    values = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    pieces = F.split(text, pattern, -1)
    empty = F.expr("cast(array() as array<struct<start:int,end:int,value:string,before:string>>)")

    def step(acc: Column, pair: Column) -> Column:
        start = acc["at"] + F.length(pair["piece"])
        end = start + F.length(pair["value"])
        item = F.struct(start.alias("start"), end.alias("end"), pair["value"].alias("value"), pair["piece"].alias("before"))
        return F.struct(end.alias("at"), F.concat(acc["found"], F.array(item)).alias("found"))

    pairs = F.arrays_zip(values.alias("value"), F.slice(pieces, 1, F.size(values)).alias("piece"))
    found = F.aggregate(pairs, F.struct(F.lit(0).alias("at"), empty.alias("found")), step, lambda acc: acc["found"])
    return found if when is None else F.when(when, found).otherwise(empty)


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(value: Column) -> Column:
    """Whether the digits of a value pass the Luhn test."""
    digits = F.reverse(_digits(value))
    numbers = F.transform(F.sequence(F.lit(1), F.length(digits)), lambda i: F.substring(digits, i, F.lit(1)).cast("int"))
    doubled = F.transform(numbers, lambda d, i: F.when(i % 2 == 0, d).when(d > 4, 2 * d - 9).otherwise(2 * d))
    return F.aggregate(doubled, F.lit(0), lambda a, d: a + d) % 10 == 0


def base_spans(text: Column) -> Column:
    """Array of (kind, start, end) of the base entities: by kind as listed, then start."""
    found = {
        "email": _places(text, EMAIL, F.contains(text, F.lit("@"))),
        "ip": F.filter(_places(text, IP), lambda m: F.forall(F.split(m["value"], r"\."), lambda p: F.regexp_replace(p, "^0+(?=[0-9])", "").rlike("^([0-9]{1,2}|1[0-9][0-9]|2[0-4][0-9]|25[0-5])$"))),
        "card": F.filter(_places(text, CARD), lambda m: luhn(m["value"])),
        "phone": F.filter(_places(text, PHONE, F.contains(text, F.lit("+"))), lambda m: F.length(_digits(m["value"])).between(8, 15)),
    }


    def spans(kind: str) -> Column:
        return F.transform(found[kind], lambda m: F.struct(F.lit(kind).alias("kind"), m["start"].alias("start"), m["end"].alias("end")))

    return F.concat(*map(spans, KINDS))


def n_of(kind: str, spans: str = "base") -> Column:
    """The number of spans of a kind."""
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def _words(text: Column) -> Column:
    """Lower case, digits as #, single blanks."""
    return F.translate(F.lower(F.regexp_replace(text, r"\s+", " ")), "0123456789", "#" * 10)


def _shape(value: Column) -> Column:
    """Runs of digits, capitals and small letters as one sign each; of a key only the length."""
    signs = value
    for run, sign in (("[0-9]+", "#"), ("[A-Z]+", "A"), ("[a-z]+", "a")):
        signs = F.regexp_replace(signs, run, sign)
    return F.when(value.rlike(KEY), F.concat(F.lit("key"), F.length(value).cast("string"))).otherwise(signs)


def _identifiers(text: Column, base: Column, places: Column) -> Column:
    """Identifier-like tokens, of their ``places``: (start, end, value, kind, free, contexts).

    ``start``, ``end`` and ``value`` leave out punctuation around the token. ``contexts`` are its patterns, form and text;
    ``kind`` that of the base entity that begins in the token, or ``secret`` for what looks like a key; ``free`` says
    that no base entity touches it.
    """

    def read(near: Column) -> Column:
        m = near["place"]
        begun = F.length(m["value"]) - F.length(F.ltrim(m["value"], F.lit(AROUND)))
        core = F.btrim(m["value"], F.lit(AROUND))
        first = F.get(F.filter(base, lambda b: (b["start"] >= m["start"]) & (b["start"] < m["end"])), F.lit(0))
        # The instance is the whole base entity, or the token.
        value = F.when(first.isNotNull(), F.substring(text, first["start"] + 1, first["end"] - first["start"])).otherwise(core)
        # The token before belongs to the words before.
        left = F.rtrim(_words(F.concat(F.coalesce(near["earlier"]["value"], F.lit("")), m["before"])))
        parts = {
            "start": m["start"] + begun,
            "end": m["start"] + begun + F.length(core),
            "value": value,
            "kind": first["kind"],
            "free": ~F.exists(base, lambda b: (b["start"] < m["end"]) & (b["end"] > m["start"])),
            "two": F.substring_index(left, " ", -2),
            "right": F.substring_index(F.ltrim(_words(near["after"])), " ", 1),
        }
        return F.struct(*[part.alias(name) for name, part in parts.items()])

    def shaped(m: Column) -> Column:
        more = {"kind": F.coalesce(m["kind"], F.when(m["free"] & m["value"].rlike(KEY), F.lit("secret"))), "one": F.substring_index(m["two"], " ", -1), "shape": _shape(m["value"])}
        return F.struct(*[m[c].alias(c) for c in ("start", "end", "value", "free", "two", "right")], *[part.alias(name) for name, part in more.items()])

    def described(m: Column) -> Column:
        one = m["one"]
        forms = {"two": m["two"], "one": one, "both": F.concat_ws(" _ ", one, m["right"]), "shaped": F.concat_ws(" ", one, m["shape"]), "shape": m["shape"]}
        lexical = (one != "") & (F.length(m["two"]) <= LONGEST_CONTEXT)
        usable = [F.when((lexical | (name == "shape")) & (F.length(context) <= 3 * LONGEST_CONTEXT), F.concat(F.lit(f"{name}:"), context)) for name, context in forms.items()]
        return F.struct(*[m[c].alias(c) for c in ("start", "end", "value", "kind", "free")], F.array_compact(F.array(*usable)).alias("contexts"))

    # Neighbours are zipped to the places: what a lambda names besides its argument is computed for each element.
    rest = F.greatest(F.size(places) - 1, F.lit(0))
    nothing = F.expr("cast(null as struct<start:int,end:int,value:string,before:string>)")
    end = F.get(places, rest)["end"]
    last = F.substring(text, end + 1, F.length(text))
    after = F.concat(F.transform(F.slice(places, 2, rest), lambda p: p["before"]), F.array(last))
    earlier = F.concat(F.array(nothing), F.slice(places, 1, rest))
    there = F.slice(F.arrays_zip(places.alias("place"), earlier.alias("earlier"), after.alias("after")), 1, F.size(places))
    # One step after the other, since a lambda computes a part again wherever it is named.
    return F.transform(F.transform(F.transform(there, read), shaped), described)


def read_entities(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """Stored (id, row, base, tokens)."""
    rows = docs.select(F.col(doc_id).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("t"))
    places = _places(F.col("t"), IDENTIFIER, F.col("t").rlike("[0-9@]"))
    rows = rows.select("id", "t", base_spans(F.col("t")).alias("base"), places.alias("places"))
    tokens = _identifiers(F.col("t"), F.col("base"), F.col("places"))
    rows = rows.select("id", "base", tokens.alias("tokens"), F.monotonically_increasing_id().alias("row"))
    return stored(rows, "entities")


def _supported(edges: DataFrame, found: DataFrame | None, min_seeds: int) -> DataFrame:
    """(context, pattern_kind): patterns with enough distinct base entities and found instances."""
    seeds = edges.where("kind IS NOT NULL").select("context", "kind")
    if found is not None:
        free = edges.where("kind IS NULL").drop("kind")
        seeds = seeds.unionByName(free.join(found.hint("merge"), "value").select("context", F.col("found_kind").alias("kind")))
    counted = seeds.groupBy("context").agg(F.count("kind").alias("seeds"), F.mode("kind", deterministic=True).alias("pattern_kind"))
    return counted.where(F.col("seeds") >= min_seeds).drop("seeds")


def _trusts(scored: DataFrame) -> DataFrame:
    # Half an instance against each pattern keeps small ones down.
    return stored(scored.groupBy("context", "pattern_kind").agg((F.sum("score") / (F.count("*") + 0.5)).alias("trust")), "pattern-trust")


def _likely(joined: DataFrame) -> DataFrame:
    """Likelihood of each (value, pattern_kind): places count as independent, the forms of a pattern don't."""
    keys, form = ["value", "pattern_kind"], F.substring_index("context", ":", 1)
    by_form = joined.groupBy(*keys, form.alias("form")).agg((1 - F.exp(F.sum(F.log1p(-F.least("trust", F.lit(0.999)))))).alias("likely"))
    return by_form.groupBy(*keys).agg(F.max("likely").alias("likely"))


def _scored(edges: DataFrame, patterns: DataFrame, found: DataFrame | None, rounds: int, confidence: float) -> DataFrame:
    """The edges of the patterns with scores after ``rounds``; a found instance counts ``confidence`` at least."""
    edges = edges.join(patterns.hint("merge"), "context")
    least = F.lit(0.0)
    if found is not None:
        edges = edges.join(found.hint("merge"), "value", "left")
        least = F.when(F.col("kind").isNull() & (F.col("found_kind") == F.col("pattern_kind")), confidence).otherwise(0.0)
    scored = edges.withColumn("least", least).drop("found_kind")
    scored = stored(scored.withColumn("score", F.when(F.col("kind") == F.col("pattern_kind"), 1.0).otherwise(F.col("least"))), "pattern-edges")
    for _ in range(rounds):
        joined = scored.drop("score").join(_trusts(scored).hint("merge"), ["context", "pattern_kind"])
        values = stored(_likely(joined), "instance-likely")
        own = F.when(F.col("kind") == F.col("pattern_kind"), 1.0).when(F.col("kind").isNotNull(), 0.0).otherwise(F.greatest("likely", "least"))
        scored = stored(joined.join(values.hint("merge"), ["value", "pattern_kind"]).withColumn("score", own).drop("likely", "trust"), "pattern-scores")
    return scored


def trusted_patterns(rows: DataFrame, rounds: int = ROUNDS, confidence: float = CONFIDENCE, min_seeds: int = MIN_SEEDS) -> DataFrame:
    """(context, kind, trust): lexical patterns of high confidence after ``rounds`` of scoring in the last generation.

    The graph has a row per distinct (pattern, value), made with map-side combining, so a pattern or a
    value of any frequency moves one row per task. A generation scores all patterns that have enough
    support; their free instances of high likelihood support patterns of the next one. Patterns and instances
    keep their kinds and only become more, so the generations end.
    """
    tokens = rows.select(F.explode("tokens").alias("t")).select("t.*").where("free OR kind IS NOT NULL")
    tokens = tokens.select("value", "kind", F.explode("contexts").alias("context"))
    edges = stored(tokens.groupBy("context", "value").agg(F.max("kind").alias("kind")), "pattern-edges")
    patterns, found = stored(_supported(edges, None, min_seeds), "patterns"), None
    while True:
        scored = _scored(edges, patterns, found, rounds, confidence)
        trusts = _trusts(scored)
        free = scored.where("kind IS NULL").select("context", "value", "pattern_kind")
        likely = _likely(free.join(trusts.hint("merge"), ["context", "pattern_kind"])).where(F.col("likely") >= confidence)
        new = likely.groupBy("value").agg(F.max(F.struct("likely", "pattern_kind"))["pattern_kind"].alias("found_kind"))
        new = stored(new if found is None else new.join(found.hint("merge"), "value", "left_anti"), "found-instances")
        if new.isEmpty():
            break
        found = new if found is None else stored(found.unionByName(new), "found-instances")
        more = _supported(edges, found, min_seeds).join(patterns.hint("merge"), "context", "left_anti")
        patterns = stored(patterns.unionByName(more), "patterns")
    trusted = trusts.where((F.col("trust") >= confidence) & ~F.startswith("context", F.lit("shape:")))
    return trusted.select("context", F.col("pattern_kind").alias("kind"), "trust")


def personal_spans(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """Per row: id, ``base`` and ``spans`` (base and discovered), arrays of (kind, start, end) in order."""
    rows = read_entities(docs, doc_id, text)
    trusted = stored(trusted_patterns(rows, **options), "trusted-patterns")
    able = F.filter("tokens", lambda t: t["free"] & (t["end"] - t["start"] >= SHORTEST_FOUND))
    tokens = rows.select("row", F.explode(able).alias("t"))
    tokens = tokens.select("row", F.col("t.start").alias("start"), F.col("t.end").alias("end"), F.explode("t.contexts").alias("context"))
    # The most trusted pattern of a token gives its kind.
    found = tokens.join(trusted.hint("merge"), "context").groupBy("row", "start", "end").agg(F.max(F.struct("trust", "kind"))["kind"].alias("kind"))
    found = found.groupBy("row").agg(F.collect_list(F.struct("kind", "start", "end")).alias("more"))
    rank = lambda s: F.array_position(F.array(*map(F.lit, KINDS + MORE_KINDS)), s["kind"])
    every = F.concat("base", F.coalesce("more", F.expr("cast(array() as array<struct<kind:string,start:int,end:int>>)")))
    ordered = F.transform(F.array_sort(F.transform(every, lambda s: F.struct(rank(s).alias("k"), s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind")))), lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end")))
    return rows.select("id", "row", "base").join(found, "row", "left").select(F.col("id").alias(doc_id), "base", ordered.alias("spans"))


def spans_text(spans: str | Column) -> Column:
    """Comma-joined kind:start:end."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def masked(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", mask: str = "*", **options) -> DataFrame:
    """id and text with every entity overwritten, character by character."""
    kept = docs.select(doc_id, text)
    found = personal_spans(kept.select(F.struct(doc_id, text).alias("key"), text), "key", text, **options)

    def step(acc: Column, s: Column) -> Column:
        start, end = F.least(s["start"], F.length(acc)), F.least(s["end"], F.length(acc))
        return F.concat(F.substring(acc, F.lit(1), start), F.repeat(F.lit(mask), end - start), F.substring(acc, end + 1, F.length(acc)))

    return found.select(f"key.{doc_id}", F.aggregate("spans", F.col(f"key.{text}"), step).alias(text))
