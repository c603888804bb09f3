"""Personal data in texts, and terms that give a protected entity away, by corpus counts.

An entity is one address, number or name of a kind below. A term discloses an entity when
their pointwise mutual information, from counts over all documents, reaches a share of the
entity's information content: PMI(e; t) = log2(N c(e,t) / (c(e) c(t))) >= share * IC(e),
IC(e) = log2(N / c(e)). Native expressions only.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from devdata_spark.llm.common import join_small, match_spans, written

# Kinds in the order of the result, and what each looks like. Loops are
# possessive and starts are anchored where that changes no match, so that long runs of
# letters or digits take linear time and no stack.
KINDS = ("email", "ip", "card", "phone")
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# What a text must hold for a look at the kind to be worth it.
HINTS = {"email": "@", "ip": r"[0-9]\.[0-9]", "card": r"(?:[0-9][\x20-]?){13}", "phone": r"\+[0-9]"}
WORD = r"\p{L}{2,}+"
SPANS = "array<struct<kind:string,start:int,end:int,found:string>>"


def base_spans(text: Column, kind: str) -> Column:
    """The valid matches of a kind: array<struct<start,end,found>>, in code points."""
    found = F.when(text.rlike(HINTS[kind]), match_spans(text, PATTERNS[kind]))
    return F.coalesce(
        F.filter(found, lambda s: _valid(kind, s["found"])),
        F.array().cast("array<struct<start:int,end:int,found:string>>"),
    )


def _valid(kind: str, found: Column) -> Column:
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        small = r"0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
        return found.rlike(rf"^(?:{small}\.){{3}}{small}$")
    digits = F.regexp_replace(found, "[^0-9]", "")
    if kind == "phone":
        return F.length(digits).between(9, 15)
    return F.length(digits).between(13, 19) & (_luhn(digits) % 10 == 0)


def _luhn(digits: Column) -> Column:
    """Sum of the digits, each second one from the right doubled and reduced by nines."""
    reverse = F.reverse(digits)
    each = F.transform(
        F.sequence(F.lit(1), F.length(digits)),
        lambda i: (
            F.substring(reverse, i, F.lit(1)).cast("int") * (F.lit(2) - i % 2)
        ),
    )
    return F.aggregate(each, F.lit(0), lambda total, v: total + v - F.when(v > 9, 9).otherwise(0))


def find(
    documents: DataFrame, doc_id: str = "doc_id", text: str = "text", share: float = 0.8,
    remove_share: float = 0.95, min_texts: int = 3, protected: list[str] | None = None,
) -> DataFrame:
    """One row per document: doc_id, text, base, terms, sanitised.

    `base` and `terms` are arrays of (kind, start, end, found), sorted by kind and start;
    `sanitised` is the text with entities replaced by [KIND], terms that disclose at least
    `remove_share` of an entity removed and the other flagged terms replaced by [TERM].

    All counts are of different texts, so copies of one text prove nothing, and a word
    counts wherever it stands in a text. A term must be met with the entity in `min_texts`
    texts, or in all of its texts if they are fewer, but at least two: in one text each
    rare word would disclose it. An entity of one text is judged by the counts of its group
    instead (an email's domain, the first three numbers of an ip, a card's first six
    digits, a phone number but for its last four); so it has no terms if its group is in
    one text too. A flagged term is marked everywhere in the documents that hold the entity.
    `protected` adds plain words as entities of kind "name", which have no group.

    NULL text counts as empty; rows of NULL doc_id get base spans and no terms; repeated
    rows each get a result; other columns are ignored. An empty table gives an empty one.
    """
    docs = documents.select(
        F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text")
    )
    marked = docs.withColumn("base", F.concat(*[_tagged(kind) for kind in KINDS]))
    extra = F.array().cast(SPANS)
    if protected:
        words = r"(?<!\p{L})(?:" + "|".join(rf"\Q{w}\E" for w in protected) + r")(?!\p{L})"
        extra = F.transform(
            match_spans(F.col("text"), words), lambda s: _tag(F.lit("name"), s)
        )
    hits = marked.withColumn("entities", F.concat("base", extra)).filter(F.size("entities") > 0)
    held = written(_held(hits), "held")
    flagged, holders = _disclosing(docs, held, share, min_texts)
    alone = F.col("with_entity") == 1
    terms = (
        held.select("doc_id", "entity", "class")
        .distinct()
        .join(holders, "entity")
        .select("doc_id", F.when(alone, F.col("class")).otherwise(F.col("entity")).alias("entity"))
        .distinct()
        .join(flagged, "entity")
        .groupBy("doc_id")
        .agg(
            F.sort_array(F.collect_set("term")).alias("words"),
            F.collect_set(F.when(F.col("ratio") >= remove_share, F.col("term"))).alias("gone"),
        )
    )
    words = F.concat(
        F.lit(r"(?iu)(?<!\p{L})(?:"), F.array_join("words", "|"), F.lit(r")(?!\p{L})")
    )
    spans = F.filter(
        F.transform(match_spans(F.col("text"), words), lambda s: _tag(F.lit("term"), s)),
        lambda s: ~F.exists("base", lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"])),
    )
    return (
        join_small(marked, terms, "doc_id", "left")
        .withColumn("terms", F.when(F.size("words") > 0, spans).otherwise(F.array().cast(SPANS)))
        .withColumn("sanitised", _sanitised())
        .select("doc_id", "text", "base", "terms", "sanitised")
    )


def _tagged(kind: str) -> Column:
    return F.transform(base_spans(F.col("text"), kind), lambda s: _tag(F.lit(kind), s))


def _tag(kind: Column, span: Column) -> Column:
    return F.struct(
        kind.alias("kind"), span["start"].alias("start"), span["end"].alias("end"),
        span["found"].alias("found"),
    )


def _held(hits: DataFrame) -> DataFrame:
    """doc_id, content, entity, class, words: each entity of a document, with all words.

    `content` is the text's hash, `class` the entity's group, and itself for a name.
    """
    personal = "|".join(PATTERNS.values())
    text = F.lower(F.regexp_replace("text", personal, " "))
    near = (
        hits.filter(F.col("doc_id").isNotNull())
        .select(
            "doc_id",
            F.xxhash64("text").alias("content"),
            F.array_distinct(F.regexp_extract_all(text, F.lit(WORD), F.lit(0))).alias("words"),
            F.explode("entities").alias("e"),
        )
    )
    kind = F.col("e.kind")
    value = F.when(
        kind.isin("card", "phone"), F.regexp_replace("e.found", "[^0-9]", "")
    ).otherwise(F.lower("e.found"))
    group = (
        F.when(kind == "email", F.regexp_replace("value", "^[^@]*", ""))
        .when(kind == "ip", F.regexp_replace("value", "[0-9]+$", ""))
        .when(kind == "card", F.substring("value", 1, 6))
        .when(kind == "phone", F.regexp_replace("value", "[0-9]{4}$", ""))
    )
    own = F.when(kind == "name", F.regexp_extract_all("value", F.lit(WORD), F.lit(0)))
    return near.withColumn("value", value).select(
        "doc_id",
        "content",
        F.concat_ws(":", kind, "value").alias("entity"),
        F.when(group.isNull(), F.concat_ws(":", kind, "value"))
        .otherwise(F.concat_ws(":", F.concat(kind, F.lit("s")), group))
        .alias("class"),
        F.array_except("words", F.coalesce(own, F.array().cast("array<string>"))).alias("words"),
    )


def _disclosing(
    docs: DataFrame, held: DataFrame, share: float, min_texts: int
) -> tuple[DataFrame, DataFrame]:
    """entity, term, ratio: terms that give away `share` of an entity or of a class of them.

    And entity, with_entity: the different texts of each.
    """
    keys = F.explode(F.array_distinct(F.array("entity", "class"))).alias("entity")
    texts = written(
        held.select(keys, "content", "words").dropDuplicates(["entity", "content"]), "texts"
    )
    holders = texts.groupBy("entity").agg(F.count("*").alias("with_entity"))
    # in one text each rare word would give an entity away
    needed = F.greatest(F.least(F.lit(min_texts), F.col("with_entity")), F.lit(2))
    together = (
        texts.select("entity", F.explode("words").alias("term"))
        .groupBy("entity", "term")
        .agg(F.count("*").alias("both"))
        .filter("both > 1")
        .join(holders, "entity")
        .filter(F.col("both") >= needed)
    )
    together = written(together, "together")
    # each text once: only texts that are repeated have to meet
    hashed = docs.select(F.xxhash64("text").alias("content"), "text")
    sizes = hashed.groupBy("content").agg(F.count("*").alias("n"))
    total = F.lit(sizes.count())
    repeated = sizes.filter("n > 1").select("content")
    once = join_small(hashed, repeated, "content", "left_anti")
    again = join_small(hashed, repeated, "content", "left_semi").dropDuplicates(["content"])
    words = once.union(again).select(
        F.explode(
            F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit(WORD), F.lit(0)))
        ).alias("term")
    )
    frequency = (
        join_small(words, together.select("term").distinct(), "term", "left_semi")
        .groupBy("term")
        .agg(F.count("*").alias("with_term"))
    )
    pmi = F.log2(total * F.col("both") / (F.col("with_entity") * F.col("with_term")))
    content = F.log2(total / F.col("with_entity"))
    flagged = (
        together.join(frequency, "term")
        .withColumn("ratio", F.when(content > 0, pmi / content))
        .filter(F.col("ratio") >= share)
        .select("entity", "term", "ratio")
    )
    return flagged, holders


def _sanitised() -> Column:
    """The text with every span replaced; of overlapping spans the first one counts."""
    spans = F.array_sort(
        F.concat(F.col("base"), F.col("terms")),
        lambda a, b: F.when(a["start"] == b["start"], b["end"] - a["end"])
        .otherwise(a["start"] - b["start"]),
    )
    zero = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("parts"))

    def step(state: Column, s: Column) -> Column:
        mark = F.when(
            s["kind"] != "term", F.concat(F.lit("["), F.upper(s["kind"]), F.lit("]"))
        ).when(F.array_contains("gone", F.lower(s["found"])), "").otherwise("[TERM]")
        between = F.substring("text", state["at"] + 1, s["start"] - state["at"])
        fresh = s["start"] >= state["at"]
        return F.struct(
            F.when(fresh, s["end"]).otherwise(state["at"]).alias("at"),
            F.when(fresh, F.concat(state["parts"], F.array(between, mark)))
            .otherwise(state["parts"])
            .alias("parts"),
        )

    done = F.aggregate(spans, zero, step)
    return F.concat(
        F.array_join(done["parts"], ""),
        F.substring("text", done["at"] + 1, F.length("text")),
    )


def as_text(spans: Column) -> Column:
    """Spans as kind:start:end, comma-joined."""
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ","
    )
