"""Facts out of free text and web pages."""

import re
from collections.abc import Sequence
from html.entities import name2codepoint

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from devdata_spark.functions import text

# The readme block that describes columns, and how a link is
# written, its target in double, single or no quotes.
SKIPPED_BLOCK = "List of Variables:"
LINK_START = r"(?i)<a(?=\s)"
LINK_TAG = r"(?s)^([^>]*)>"
LINK_BODY = r"(?is)^[^>]*>(.*?)(?:</a\s*>|\z)"
TARGET = r"(?is)\shref\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))"
COMMENTS_AND_SCRIPTS = r"(?is)<!--.*?-->|<script\b.*?</script\s*>|<style\b.*?</style\s*>"
# A character by its name or number, at the start of what follows an ampersand.
ENTITY = r"^(#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|[A-Za-z][A-Za-z0-9]*);"
SECTION_EDGE = r"(?i)(?=<section\b)|(?=</section\s*>)"


def key_values(df: DataFrame, column: str, by: Sequence[str]) -> DataFrame:
    """`key` and `value` pairs of a readme-like text, for each document `by`.

    Blocks are separated by a blank line. The first line of a block is split at
    its first colon, the lines below continue the value. A block without a colon
    in its first line is skipped, as is the list of variables. Where a document
    repeats a key the last block wins.
    """
    unix = F.regexp_replace(F.col(column), "\r\n?", "\n")
    # the outer form: the plain one would split every text once more for a filter
    blocks = df.select(*by, F.posexplode_outer(F.split(unix, "\n\n")).alias("_at", "_raw")).select(
        *by, "_at", text.strip(F.col("_raw")).alias("_block")
    )
    block = F.col("_block")
    kept = blocks.where(
        ~block.startswith(SKIPPED_BLOCK) & F.substring_index(block, "\n", 1).contains(":")
    )
    head = F.substring_index(block, ":", 1)
    lines = F.split(F.substr(block, F.length(head) + 2), "\n")
    value = text.strip(F.array_join(F.transform(lines, text.strip), " "))
    pairs = kept.select(*by, "_at", text.strip(head).alias("key"), value.alias("value"))
    return pairs.groupBy(*by, "key").agg(F.max_by("value", "_at").alias("value"))


def links(
    df: DataFrame,
    column: str,
    by: Sequence[str],
    *,
    section: str | None = None,
    prefix: str = "",
) -> DataFrame:
    """`link_text` and `href` of the links of each page `by`.

    `section` limits the search to the `<section>` with that id, up to its own end:
    sections inside it belong to it. Only links whose
    text starts with `prefix` are kept; where a page repeats a text, its last link
    wins. The text is what a reader sees: without inner tags, entities decoded.
    """
    page = F.regexp_replace(F.col(column), COMMENTS_AND_SCRIPTS, "")
    if section is not None:
        page = _inside(page, section)
    # each piece runs from the inside of one link's tag to the next link; the
    # first piece is what comes before any link
    pieces = df.select(*by, F.posexplode_outer(F.split(page, LINK_START)).alias("_at", "_piece"))
    tag = F.regexp_extract("_piece", LINK_TAG, 1)
    targets = [F.nullif(F.regexp_extract(tag, TARGET, i), F.lit("")) for i in (1, 2, 3)]
    body = F.regexp_replace(F.regexp_extract("_piece", LINK_BODY, 1), "(?s)<[^>]*>", "")
    links_ = pieces.where("_at > 0").select(
        *by, "_at", _plain(body).alias("link_text"), _plain(F.coalesce(*targets)).alias("href")
    )
    found = links_.where(F.col("href").isNotNull() & F.col("link_text").startswith(prefix))
    return found.groupBy(*by, "link_text").agg(F.max_by("href", "_at").alias("href"))


def has_section(page: Column, section: str) -> Column:
    """Whether a page has a `<section>` with that id, outside comments and scripts."""
    return F.regexp_replace(page, COMMENTS_AND_SCRIPTS, "").rlike(_section_start(section))


def _section_start(section: str) -> str:
    return rf"(?is)<section\b[^>]*\bid\s*=\s*[\"']{re.escape(section)}[\"'][^>]*>"


def _inside(page: Column, section: str) -> Column:
    """What stands between the tag that starts the section and the one that ends it.

    Behind the start, the page is cut before each tag of a section. Pieces count as long
    as more sections are open than closed.
    """
    rest = F.regexp_extract(page, _section_start(section) + r"(.*)\z", 1)
    state = F.struct(F.lit(1).alias("open"), F.array().cast("array<string>").alias("kept"))

    def step(so_far: Column, piece: Column) -> Column:
        change = F.when(piece.rlike("(?i)^</section"), -1).when(
            piece.rlike(r"(?i)^<section\b"), 1
        ).otherwise(0)
        now = F.when(so_far["open"] > 0, so_far["open"] + change).otherwise(0)
        kept = F.when(now > 0, F.concat(so_far["kept"], F.array(piece))).otherwise(so_far["kept"])
        return F.struct(now.alias("open"), kept.alias("kept"))

    pieces = F.split(rest, SECTION_EDGE, -1)
    return F.array_join(F.aggregate(pieces, state, step)["kept"], "")


def _plain(c: Column) -> Column:
    """Text with its character references resolved, each once, from left to right."""
    names = F.create_map(
        *[x for name, code in name2codepoint.items() for x in (F.lit(name), F.lit(chr(code)))],
        F.lit("apos"), F.lit("'"),
    )

    def resolved(piece: Column) -> Column:
        reference = F.regexp_extract(piece, ENTITY, 1)
        digits = F.regexp_extract(reference, r"^#[xX]?(.*)$", 1)
        hexadecimal = reference.rlike("^#[xX]")
        code = F.conv(digits, 10, 16)
        code = F.lpad(F.when(hexadecimal, digits).otherwise(code), 8, "0")
        # surrogates and numbers beyond the last plane stand for no character
        valid = (code <= "0010FFFF") & ~F.upper(code).between("0000D800", "0000DFFF")
        numbered = F.when(valid, F.decode(F.unhex(code), "UTF-32"))
        character = F.when(reference.startswith("#"), numbered).otherwise(
            F.try_element_at(names, reference)
        )
        tail = F.substr(piece, F.length(reference) + 2)
        return F.when((reference != "") & character.isNotNull(), F.concat(character, tail)).otherwise(
            F.concat(F.lit("&"), piece)
        )

    pieces = F.split(c, "&", -1)
    rest = F.transform(F.slice(pieces, F.lit(2), F.size(pieces)), resolved)
    return F.when(~F.contains(c, F.lit("&")), c).otherwise(
        F.concat(F.get(pieces, F.lit(0)), F.array_join(rest, ""))
    )
