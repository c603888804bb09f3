"""The array code inside tasks against plain Python."""

import random

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from devdata_spark.llm import bwt, contamination, line_dedup, linking, ngram_join, suffix_dedup


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet="ab", min_size=1, max_size=120), st.integers(2, 12))
def test_groups_are_suffixes_with_equal_beginnings(text, length):
    symbols = np.frombuffer(text.encode(), np.uint8).astype(np.uint16)
    order, group = bwt.groups(symbols, length)
    assert sorted(order) == list(range(len(text)))
    # a shorter suffix is a group of its own: its end differs from any symbol
    starts = [text[i : i + length] + "$" * int(i + length > len(text)) for i in order]
    for i in range(1, len(order)):
        assert (group[i] == group[i - 1]) == (starts[i] == starts[i - 1])


def test_groups_of_long_repeats():
    rng = random.Random(1)
    part = bytes(rng.choices(b"abcd", k=300))
    content = part + bytes(rng.choices(b"abcd", k=200)) + part + b"a" * 400
    symbols = np.frombuffer(content, np.uint8).astype(np.uint16)
    order, group = bwt.groups(symbols, 50)
    found = {}
    for i, g in zip(order, group):
        if i + 50 <= len(content):
            found.setdefault(g, set()).add(content[i : i + 50])
    assert all(len(strings) == 1 for strings in found.values())
    assert len(found) == len({content[i : i + 50] for i in range(len(content) - 49)})


def test_a_block_has_a_place_for_each_symbol():
    with pytest.raises(ValueError):
        bwt.groups(np.full(bwt.BLOCK + 1, 97, np.uint16), 50)


def test_anchors_cover_all_strings_and_depend_on_content_only():
    rng = random.Random(2)
    content = np.frombuffer(bytes(rng.choices(b"abc", k=2000)), np.uint8)
    hashes, first, last = suffix_dedup.anchors(content)
    assert first[0] == 0 and last[-1] == len(content) - suffix_dedup.LENGTH
    assert (first[1:] == last[:-1] + 1).all()
    for at in (0, 17, 500, 1950):
        own = hashes[np.searchsorted(last, at)]
        alone = suffix_dedup.anchors(content[at : at + suffix_dedup.LENGTH])[0]
        assert alone.tolist() == [own]
    assert len(suffix_dedup.anchors(content[:49])[0]) == 0


def edit_distance_to_part(probe, place):
    row = [0] * (len(place) + 1)
    for i, p in enumerate(probe, 1):
        before, row = row, [i]
        for j, c in enumerate(place, 1):
            row.append(min(before[j - 1] + (p != c), before[j] + 1, row[j - 1] + 1))
    return min(row)


@settings(max_examples=200, deadline=None)
@given(st.text("ab", min_size=1, max_size=20), st.text("ab", max_size=30), st.integers(0, 6))
def test_banded_distance_is_the_edit_distance_within_the_budget(probe, place, edits):
    codes = [np.frombuffer(t.encode("utf-32-le"), np.uint32) for t in (probe, place)]
    found, end = contamination.banded_distance(*codes, edits)
    true = edit_distance_to_part(probe, place)
    if true <= edits:
        assert found == true
        assert edit_distance_to_part(probe, place[:end]) == true
    else:
        assert found > edits


def test_every_passage_with_allowed_edits_is_found():
    rng = random.Random(7)
    letters = "abcdefghij é"
    item = "".join(rng.choices(letters, k=260))
    index = contamination.Index([(5, item), (6, "too short"), (7, None)])
    for _ in range(60):
        passage = list(item[60:200])
        for _ in range(4):
            at = rng.randrange(len(passage))
            passage[at : at + 1] = rng.choice([[], ["z"], ["z", passage[at]]])
        text = "".join(rng.choices(letters, k=rng.randrange(300))) + "".join(passage) + "x" * 50
        whole = contamination.normalised(text).tobytes().decode("utf-32-le")
        expected = {
            start
            for (_, start, probe), edits in zip(index.probes, index.edits)
            if edit_distance_to_part(probe, whole) <= edits
        }
        found = index.search([text])[0]
        assert {m[1] for m in found} == expected and {m[0] for m in found} <= {5}
    assert index.search(["", None, "x" * 5000, " ".join(letters) * 400]) == [[], [], [], []]


def test_normalised_text_has_single_spaces_and_lower_case():
    found = contamination.normalised("A--b\n\tÉ!!  1𝟙").tobytes().decode("utf-32-le")
    assert found == "a b é 1𝟙"
    assert len(contamination.normalised("")) == 0


def test_similar_lines_share_a_band():
    rng = random.Random(11)
    missed = pairs = 0
    for size in (30, 60, 120, 400):
        for _ in range(150):
            line = "".join(rng.choices("abcdefghijklmnop ", k=size))
            other = list(line)
            for _ in range(max(1, size // 120)):
                other[rng.randrange(size)] = "Z"
            other = "".join(other)
            a, b = line_dedup.shingle_set(line), line_dedup.shingle_set(other)
            if len(a & b) / len(a | b) >= line_dedup.PERCENT / 100:
                pairs += 1
                keys = line_dedup.band_keys([line, "between", other])
                missed += not (keys[0] == keys[2]).any()
    assert pairs > 250 and missed <= pairs * 0.02


def test_band_keys_depend_on_the_shingle_set_only():
    lines = ["", "a", "short", "exactly8", "aaaaaaaaaaaaaaaaaaaa", "x" * 5000, "é" * 9]
    together = line_dedup.band_keys(lines)
    for line, keys in zip(lines, together):
        assert (line_dedup.band_keys([line])[0] == keys).all()
    assert (together[4] == line_dedup.band_keys(["a" * 9])[0]).all()


@settings(max_examples=60, deadline=None)
@given(st.integers(10, 400), st.randoms(use_true_random=False))
def test_linked_sets_share_a_signature(size, rng):
    sets = {rng.getrandbits(64) for _ in range(size)}
    other = set(sets)
    edges = ngram_join._edges(1000)
    for _ in range(rng.randrange(size)):
        change = set(other)
        if rng.random() < 0.5:
            change.discard(rng.choice(sorted(change)))
        else:
            change.add(rng.getrandbits(64))
        if 100 * len(change & sets) < 90 * len(change | sets):
            break
        other = change
    if other == sets:
        return
    small, large = sorted((np.array(sorted(s), np.uint64) for s in (sets, other)), key=len)
    scheme = int(np.searchsorted(edges, len(small), side="right")) - 1
    above = int(np.searchsorted(edges, len(large), side="right")) - 1
    assert above in (scheme, scheme + 1)
    for many in (1, 10**6, 10**12):
        plan = ngram_join.allocate(size, ngram_join.budget(edges, scheme), many)
        a, b = (set(ngram_join.signatures(s, scheme, *plan).tolist()) for s in (small, large))
        assert a & b


def test_shingles_follow_the_word_rule():
    one = ngram_join.shingles("A b\x0bc  d")
    assert len(one) == 2 and (one == ngram_join.shingles("a B\tc  D")).all()
    assert len(ngram_join.shingles("a b c d")) == 2
    assert len(ngram_join.shingles("a b")) == 1
    assert len(ngram_join.shingles(" \n")) == len(ngram_join.shingles(None)) == 0


def test_pairs_of_crowded_keys_are_ruled_out_before_they_are_rows():
    rng = np.random.default_rng(5)
    sets = [np.unique(rng.integers(0, 2**63, 100).astype(np.uint64)) for _ in range(90)]
    sets += [np.unique(np.r_[s[:96], rng.integers(0, 2**63, 4).astype(np.uint64)]) for s in sets[:5]]
    sketches = np.array([linking.sketch(s) for s in sets])
    keys = np.repeat([1, 2, 3], [30, 45, len(sets)])
    node = np.r_[np.arange(30), np.arange(30, 75), np.arange(len(sets))]
    columns = {"key": keys, "node": node, "root": node, "top": np.full(len(node), -1)}
    columns["n"] = np.array([len(s) for s in sets])[node]
    columns |= {name: sketches[node, i] for i, name in enumerate(linking.SKETCH)}
    batches = pa.table(columns).to_batches(max_chunksize=17)
    found = [p for b in linking._key_scorer(90)(iter(batches)) for p in zip(*b.to_pydict().values())]
    assert sorted(found) == [(i, 90 + i) for i in range(5)]
    columns["root"] = node % 90
    inside = linking._key_scorer(90)(iter(pa.table(columns).to_batches()))
    assert sum(b.num_rows for b in inside) == 0
