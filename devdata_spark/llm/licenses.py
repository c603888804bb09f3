"""License mentions: ordered signature rules behind a keyword gate. Native only.

A rule is a pattern over a text's words (lower-case, one space between), a label, the
keyword without which it cannot match, alone or in one of the `WRITTEN` forms, and its
place in the order, which is its priority.
A detection inside another one of no lower priority is suppressed.
"""

from itertools import product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from devdata_spark.llm.common import match_spans

# The base phrases and their labels. They come first and always stay.
BASE = [
    ("mit", "mit", "under the mit license"),
    ("apache-2", "apache", "apache license version 2"),
    ("cc-by-nc", "cc", "cc by nc"),
]
LICENSE = "licen[sc]es?"
VERSION = "(?:(?:version|v|ver) )?v?"

# Families with versions: label, keyword, long name, short name, versions.
FAMILIES = [
    ("agpl", "affero", "(?:gnu )?affero general public " + LICENSE, None, "1 3"),
    ("agpl", "agpl", None, "agpl", "1 3"),
    ("lgpl", "lesser", "(?:gnu )?lesser general public " + LICENSE, None, "2.1 3"),
    ("lgpl", "library", "(?:gnu )?library general public " + LICENSE, None, "2"),
    ("lgpl", "lgpl", None, "(?:gnu )?lgpl", "2 2.1 3"),
    ("gpl", "general", "(?:gnu )?general public " + LICENSE, None, "1 2 3"),
    ("gpl", "gpl", None, "(?:gnu )?gpl", "1 2 3"),
    ("gfdl", "documentation", "gnu free documentation " + LICENSE, None, "1.1 1.2 1.3"),
    ("gfdl", "gfdl", None, "gfdl", "1.1 1.2 1.3"),
]
NUMBERED = [
    ("apache", "apache", "apache (?:software )?" + LICENSE, "1.0 1.1 2.0"),
    ("apache", "asl", "asl", "1.1 2.0"),
    ("mpl", "mozilla", "mozilla public " + LICENSE, "1.0 1.1 2.0"),
    ("mpl", "mpl", "mpl", "1.0 1.1 2.0"),
    ("epl", "eclipse", "eclipse public " + LICENSE, "1.0 2.0"),
    ("epl", "epl", "epl", "1.0 2.0"),
    ("cddl", "distribution", "common development and distribution " + LICENSE, "1.0 1.1"),
    ("cddl", "cddl", "cddl", "1.0 1.1"),
    ("cpl", "common", "common public " + LICENSE, "1.0"),
    ("eupl", "european", "european union public " + LICENSE, "1.0 1.1 1.2"),
    ("eupl", "eupl", "eupl", "1.0 1.1 1.2"),
    ("artistic", "artistic", "artistic " + LICENSE, "1.0 2.0"),
    ("afl", "academic", "academic free " + LICENSE, "1.1 1.2 2.0 2.1 3.0"),
    ("osl", "open", "open software " + LICENSE, "1.0 1.1 2.0 2.1 3.0"),
    ("lppl", "latex", "latex project public " + LICENSE, "1.0 1.1 1.2 1.3"),
    ("lppl", "lppl", "lppl", "1.0 1.1 1.2 1.3"),
    ("bsl", "boost", "boost software " + LICENSE, "1.0"),
    ("zpl", "zope", "zope public " + LICENSE, "1.1 2.0 2.1"),
    ("php", "php", "php " + LICENSE, "3.0 3.01"),
    ("psf", "python", "python (?:software foundation )?" + LICENSE, "2.0"),
    ("ofl", "sil", "sil open font " + LICENSE, "1.0 1.1"),
    ("ofl", "ofl", "ofl", "1.0 1.1"),
    ("odbl", "database", "open (?:data commons open )?database " + LICENSE, "1.0"),
    ("cecill", "cecill", "cecill(?: free software)?(?: " + LICENSE + ")?", "1.0 1.1 2.0 2.1"),
    ("ecl", "educational", "educational community " + LICENSE, "1.0 2.0"),
    ("rpl", "reciprocal", "reciprocal public " + LICENSE, "1.1 1.5"),
    ("qpl", "q", "q public " + LICENSE, "1.0"),
    ("upl", "universal", "universal permissive " + LICENSE, "1.0"),
    ("busl", "business", "business source " + LICENSE, "1.1"),
    ("sspl", "server", "server side public " + LICENSE, "1"),
    ("elastic", "elastic", "elastic " + LICENSE, "2.0"),
]
CREATIVE = {  # elements of a Creative Commons license: short form, long form
    "by-nc-sa": ("by nc sa", "attribution non ?commercial share ?alike"),
    "by-nc-nd": ("by nc nd", "attribution non ?commercial no ?deriv(?:ative)?s?(?: works)?"),
    "by-nc": ("by nc", "attribution non ?commercial"),
    "by-sa": ("by sa", "attribution share ?alike"),
    "by-nd": ("by nd", "attribution no ?deriv(?:ative)?s?(?: works)?"),
    "by": ("by", "attribution"),
}
CREATIVE_VERSIONS = "1.0 2.0 2.5 3.0 4.0"
SINGLE = [
    ("bsd-0-clause", "bsd", "(?:zero|0) clause bsd|0bsd|bsd (?:zero|0) clause"),
    ("bsd-1-clause", "bsd", "(?:one|1) clause bsd|bsd (?:one|1) clause"),
    ("bsd-2-clause", "bsd", "(?:two|2) clause bsd|bsd (?:two|2) clause|simplified bsd"),
    ("bsd-2-clause", "freebsd", "freebsd " + LICENSE),
    ("bsd-3-clause", "bsd", "(?:three|3) clause bsd|bsd (?:three|3) clause"),
    ("bsd-3-clause", "bsd", "(?:new|modified|revised) bsd(?: " + LICENSE + ")?"),
    ("bsd-4-clause", "bsd", "(?:four|4) clause bsd|bsd (?:four|4) clause|original bsd"),
    ("bsd", "bsd", "bsd (?:style )?" + LICENSE),
    ("bsd-text", "redistributions", "redistributions of source code must retain the above"),
    ("bsd-text", "redistribution", "redistribution and use in source and binary forms"),
    ("mit-text", "granted", "permission is hereby granted free of charge to any person"),
    ("mit", "mit", "mit (?:style )?" + LICENSE),
    ("mit", "mit", LICENSE + " mit"),
    ("mit", "expat", "expat " + LICENSE),
    ("x11", "x11", "(?:mit )?x11 " + LICENSE),
    ("isc", "isc", "isc " + LICENSE),
    ("isc-text", "permission", "permission to use copy modify and or distribute this software"),
    ("zlib", "zlib", "zlib(?: libpng)? " + LICENSE),
    ("unlicense", "unlicense", "the unlicense|unlicense org"),
    ("public-domain", "domain", "(?:released|placed|dedicated|is) (?:in|into|to) the public domain"),
    ("public-domain", "domain", "public domain dedication"),
    ("cc0-1.0", "cc0", "cc0(?: 1 0)?(?: universal)?"),
    ("cc0-1.0", "zero", "creative commons zero"),
    ("wtfpl", "wtfpl", "wtfpl"),
    ("wtfpl", "want", "do what the fuck you want to public " + LICENSE),
    ("ms-pl", "microsoft", "microsoft public " + LICENSE),
    ("ms-rl", "microsoft", "microsoft reciprocal " + LICENSE),
    ("ncsa", "ncsa", "(?:university of illinois )?ncsa(?: open source)? " + LICENSE),
    ("postgresql", "postgresql", "postgresql " + LICENSE),
    ("openssl", "openssl", "openssl " + LICENSE),
    ("ruby", "ruby", "ruby " + LICENSE),
    ("perl", "perl", "same terms as perl(?: itself)?"),
    ("vim", "vim", "vim " + LICENSE),
    ("curl", "curl", "curl " + LICENSE),
    ("beerware", "beerware", "beerware(?: " + LICENSE + ")?"),
    ("json", "evil", "shall be used for good not evil"),
    ("llama", "llama", "llama (?:2 |3 )?community " + LICENSE),
    ("openrail", "openrail", "(?:creativeml )?(?:open ?rail)(?: m| s)?"),
    ("apache", "apache", "apache (?:software )?" + LICENSE),
    ("mpl", "mozilla", "mozilla public " + LICENSE),
    ("epl", "eclipse", "eclipse public " + LICENSE),
    ("gpl", "general", "(?:gnu )?general public " + LICENSE),
    ("lgpl", "lesser", "(?:gnu )?lesser general public " + LICENSE),
    ("agpl", "affero", "(?:gnu )?affero general public " + LICENSE),
    ("gpl", "gpl", "gnu gpl|gpl " + LICENSE),
    ("lgpl", "lgpl", "lgpl"),
    ("agpl", "agpl", "agpl"),
    ("creative-commons", "creative", "creative commons(?: " + LICENSE + ")?"),
    ("spdx", "spdx", "spdx license identifier [^ ]+"),
    ("proprietary", "proprietary", "proprietary and confidential|proprietary " + LICENSE),
    ("proprietary", "redistribute", "(?:may|do) not (?:copy or )?redistribute"),
    ("all-rights-reserved", "reserved", "all rights reserved"),
    ("copyright", "copyright", "copyright (?:c )?(?:19|20)[0-9][0-9]"),
]

# Other words that a match may have in place of its keyword.
WRITTEN = {"bsd": ["0bsd"], "openrail": ["rail"]} | {
    word: [word + v for v in ("v", "ver", "version")]
    + [word + v + digit for v in ("", "v") for digit in "123"]
    for _, word, _, short, _ in FAMILIES
    if short
}


def rules() -> list[tuple[str, str, str, float]]:
    """All rules in order of priority: label, keyword, pattern, weight."""
    found = [(label, word, phrase, 1.0) for label, word, phrase in BASE]
    later = " or (?:at your option )?(?:any )?(?:later|newer|higher|above)(?: version)?"
    for label, word, long, short, versions in FAMILIES:
        for version in versions.split():
            number = _number(version)
            published = "(?: as published by the free software foundation)?(?: either)?"
            name = f"{long}{published} {VERSION}{number}" if long else f"{short} ?{VERSION}{number}"
            weight = 1.0 if long else 0.8
            found.append((f"{label}-{version}-or-later", word, name + later, weight))
            if short:
                found.append((f"{label}-{version}-or-later", word, name + r"(?: plus|\+)", weight))
            found.append((f"{label}-{version}-only", word, name + " only", weight))
            found.append((f"{label}-{version}", word, name, weight))
    elements = CREATIVE.items()
    for (label, (short, long)), version in product(elements, CREATIVE_VERSIONS.split()):
        number = _number(version)
        where = "(?: international| unported| generic)?"
        found.append((f"cc-{label}-{version}", "cc", f"cc {short} {VERSION}{number}{where}", 1.0))
        found.append(
            (f"cc-{label}-{version}", "commons", f"creative commons {long}(?: {LICENSE})? "
             f"{VERSION}{number}{where}(?: {LICENSE})?", 1.0)
        )
    for label, (short, long) in elements:
        found.append((f"cc-{label}", "cc", f"cc {short}", 0.8))
        found.append((f"cc-{label}", "commons", f"creative commons {long}", 0.8))
    for label, word, name, versions in NUMBERED:
        for version in versions.split():
            found.append((f"{label}-{version}", word, f"{name} {VERSION}{_number(version)}", 0.9))
    notices = {"all-rights-reserved", "copyright", "creative-commons"}
    found += [(a, b, c, 0.4 if a in notices else 0.7) for a, b, c in SINGLE]
    return found


def _number(version: str) -> str:
    """A version over words: 2.1 is `2 1`; a last zero may be left out."""
    whole, _, part = version.partition(".")
    return whole + {"": "(?: 0)?", "0": "(?: 0)?"}.get(part, f" {part}") + "(?! [0-9])"


# What lies between words, before or after letters are lowered.
BETWEEN = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]++"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def scan(documents: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: doc_id, n_words, base, detections.

    `base` holds the places of the base phrases, `detections` all that is left after
    suppression, as (label, start, end, rank, weight) in words, end exclusive. Base places
    are never suppressed. NULL text counts as empty; a NULL doc_id stays; repeated rows
    each get a result; other columns are ignored.
    """
    ordered = [(a, b, c, float(d), i) for i, (a, b, c, d) in enumerate(rules())]
    keywords = sorted({rule[1] for rule in ordered})
    keyword_of = {form: word for word in keywords for form in (word, *WRITTEN.get(word, []))}
    docs = documents.select(
        F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text")
    )
    words = F.concat(
        F.lit(" "),
        F.translate(F.trim(F.regexp_replace("text", BETWEEN, " ")), UPPER, LOWER),
        F.lit(" "),
    )
    by_word = F.create_map(
        *[
            x
            for word in keywords
            for x in (F.lit(word), F.array(*[_rule(r) for r in ordered if r[1] == word]))
        ]
    )
    form_of = F.create_map(*[F.lit(x) for pair in keyword_of.items() for x in pair])
    present = F.array_distinct(F.transform("forms", lambda form: form_of[form]))
    matched = F.flatten(
        F.transform(F.flatten(F.transform(present, lambda w: by_word[w])), _detections)
    )
    empty = F.array().cast(
        "array<struct<label:string,start:int,end:int,rank:int,weight:double>>"
    )
    # `lower` changes letters beyond A-Z too: the gate may let a text more pass, no less
    parts, last = F.col("parts"), F.size("parts") - 1
    ends = (F.get(parts, F.lit(0)) == "").cast("int")
    ends += ((last > 0) & (F.get(parts, last) == "")).cast("int")
    forms = F.array_intersect(parts, F.array(*map(F.lit, keyword_of)))
    return (
        docs.withColumn("parts", F.split(F.lower("text"), BETWEEN, -1))
        .withColumn("n_words", (F.size(parts) - ends).cast("long"))
        .withColumn("forms", forms)
        .withColumn("words", F.when(F.size("forms") > 0, words))
        .withColumn("all", F.when(F.col("words").isNotNull(), matched).otherwise(empty))
        .withColumn("base", F.filter("all", lambda d: d["rank"] < len(BASE)))
        .withColumn("detections", F.filter("all", lambda d: ~_suppressed(d)))
        .select("doc_id", "n_words", "base", "detections")
    )


def _rule(rule: tuple) -> Column:
    label, _, pattern, weight, rank = rule
    return F.struct(
        F.lit(label).alias("label"),
        F.lit(f"(?<= )(?:{pattern})(?= )").alias("pattern"),
        F.lit(weight).alias("weight"),
        F.lit(rank).alias("rank"),
    )


def _spaces(text: Column) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(" "), F.lit("")))


def _detections(rule: Column) -> Column:
    """Word places of one rule: the text's first space stands before word 0."""
    return F.transform(
        match_spans(F.col("words"), rule["pattern"], _spaces),
        lambda s: F.struct(
            rule["label"].alias("label"),
            (s["start"] - 1).alias("start"),
            s["end"].alias("end"),
            rule["rank"].alias("rank"),
            rule["weight"].alias("weight"),
        ),
    )


def _suppressed(d: Column) -> Column:
    """Inside a longer detection of no lower priority, or at the place of a higher one."""

    def covers(other: Column) -> Column:
        inside = (other["start"] <= d["start"]) & (d["end"] <= other["end"])
        return inside & (other["rank"] < d["rank"])

    return (d["rank"] >= len(BASE)) & F.exists("all", covers)
