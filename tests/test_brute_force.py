"""Text operators against plain Python on many random small texts."""

import random
import re

from pyspark.sql import functions as F

from devdata_spark.functions import text
from devdata_spark.operators import latest, reshape
from devdata_spark.sources import documents


def random_texts(alphabet, n, longest, seed):
    rng = random.Random(seed)
    return ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, longest))) for _ in range(n)]


def test_footnotes_and_labels(spark):
    texts = random_texts([" ", "\t", "1", "2", "/", "a", "B", "\n", " "], 3000, 9, 1)
    df = spark.createDataFrame(list(enumerate(texts)), "n INT, c STRING")
    c = F.col("c")
    found = df.orderBy("n").select(text.strip_footnote(c), text.label(c), text.capitalise(c)).collect()
    for given, row in zip(texts, found, strict=True):
        stripped = re.sub(r"\s*\d+/\s*$", "", given).strip()
        assert tuple(row) == (stripped, stripped.capitalize() or None, given.capitalize()), repr(given)


def test_codes_and_years(spark):
    texts = random_texts(["_", "A", "b", "2", "0", " "], 2000, 8, 2)
    df = spark.createDataFrame(list(enumerate(texts)), "n INT, indicator_code STRING")
    found = reshape.split_code_year(df).orderBy("n").collect()
    for given, row in zip(texts, found, strict=True):
        code, _, year = given.rpartition("_") if "_" in given else (given, "", "")
        expected = int(year) if re.fullmatch(r"\s*\d{1,9}\s*", year) else None
        assert (row.indicator_code, row.year) == (code, expected), repr(given)


def facts(content):
    content = content.replace("\r\n", "\n").replace("\r", "\n")
    found = {}
    for block in content.split("\n\n"):
        lines = block.strip().split("\n")
        if ":" not in lines[0] or lines[0].startswith("List of Variables:"):
            continue
        key, first = lines[0].split(":", 1)
        found[key.strip()] = " ".join(line.strip() for line in [first, *lines[1:]]).strip()
    return found


def test_readme_facts(spark):
    pieces = [":", "\n", "\r\n", "\r", "\n\n", " ", "K", "v w", "List of Variables:", "\t"]
    texts = random_texts(pieces, 2000, 14, 3)
    df = spark.createDataFrame(list(enumerate(texts)), "n INT, c STRING")
    found = {n: {} for n in range(len(texts))}
    for row in documents.key_values(df, "c", ["n"]).collect():
        found[row.n][row.key] = row.value
    for n, given in enumerate(texts):
        assert found[n] == facts(given), repr(given)


def test_links_of_pages(spark):
    rng = random.Random(4)
    pages, expected = [], []
    for _ in range(500):
        page, wanted = "<html>", {}
        for _ in range(rng.randint(0, 6)):
            label, target = rng.choice(["HS1", "HS2", "other"]), f"/f{rng.randint(0, 99)}?a&amp;b"
            quote = rng.choice(['"', "'"])
            before = rng.choice(["", ' class="x"', "\n id=y"])
            page += rng.choice(["", "<a name=z>HS3</a>", "<abbr>HS4</abbr>", "<!--<a href=/c>HS5</a>-->", "<p>HS6</p>"])
            page += f"<a{before} href={quote}{target}{quote}><i>{label[:1]}</i>{label[1:]}</a>"
            wanted[label] = target.replace("&amp;", "&")
        pages.append(page + "</html>")
        expected.append({k: v for k, v in wanted.items() if k.startswith("HS")})
    df = spark.createDataFrame(list(enumerate(pages)), "n INT, html STRING")
    found = {n: {} for n in range(len(pages))}
    for row in documents.links(df, "html", ["n"], prefix="HS").collect():
        found[row.n][row.link_text] = row.href
    assert [found[n] for n in range(len(pages))] == expected


def test_most_recent_values(spark):
    rng = random.Random(5)
    data = [
        (rng.choice("AB"), rng.choice("XY"), rng.randint(2000, 2006), rng.choice([None, 1.0, 2.0]))
        for _ in range(200)
    ]
    df = spark.createDataFrame(data, "entity_code STRING, indicator_code STRING, year INT, value DOUBLE")
    for n in (1, 3, 30):
        expected = []
        for key in {(r[0], r[1]) for r in data}:
            filled = [r for r in data if (r[0], r[1]) == key and r[3] is not None]
            expected += sorted(filled, key=lambda r: (-r[2], r[3]))[:n]
        found = [tuple(r) for r in latest.most_recent_values(df, n).collect()]
        assert sorted(found) == sorted(expected)
