import random
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tallycard.llm import jaccard
from tallycard.llm.components import components

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, node long, region string, root int, n_shingles string"


def made(spark, rows):
    return spark.createDataFrame([(n, text, 5, "clash", 6, "clash") for n, text in rows], SCHEMA)


def lower(text):
    return re.sub("[A-Z]", lambda m: m.group().lower(), text or "")


def shingles(text, size):
    words = WORDS.findall(lower(text))
    if len(words) < size:
        return {tuple(words)} if words else set()
    return {tuple(words[at : at + size]) for at in range(len(words) - size + 1)}


def brute(rows, size, percent):
    """(doc_id, n_shingles, component id) of each row."""
    sets = [shingles(text, size) for _, text in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            common = len(sets[a] & sets[b])
            if common and 100 * common >= percent * (len(sets[a]) + len(sets[b]) - common):
                root[find(a)] = find(b)
    least = {}
    for at, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            least[find(at)] = min(least.get(find(at), doc_id), doc_id)
    return sorted(
        ((d, len(s), least.get(find(at)) if s else d) for at, ((d, _), s) in enumerate(zip(rows, sets))), key=repr
    )


def corpus():
    """Near copies at all distances around the threshold, a passage in many documents, and odd texts."""
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(4))
    rows, passage = [], " ".join(word() for _ in range(25))
    for family in range(6):
        base = [word() for _ in range(60 + 30 * family)]
        for copy in range(7):
            words = list(base)
            for _ in range(rng.randrange(0, 5)):
                words[rng.randrange(len(words))] = word()
            rows.append(" ".join(words) + (" " + passage if copy % 3 == 0 else ""))
    rows += [" ".join(word() for _ in range(8)) + " " + passage for _ in range(12)]
    rows += [None, "", " \n\t", "one", "ONE", "one two", "one  two\n", "One Two Three", "é É", " "]
    rows += [rows[0], rows[0].upper(), " ".join(word() for _ in range(20_000))]
    numbered = list(enumerate(rows, 100))
    return numbered + [(None, rows[0]), (None, "null alone here now"), (3, rows[8]), (3, "same id other text at all")]


@pytest.mark.parametrize("limits", [None, (300, 40)])
def test_components_equal_brute_force(spark, monkeypatch, limits):
    if limits:
        monkeypatch.setattr(jaccard, "MOST_SHINGLES", limits[0])
        monkeypatch.setattr(jaccard, "LEAST_WEIGHT", limits[1])
    rows = corpus()
    found = sorted(map(tuple, jaccard.classes(made(spark, rows)).collect()), key=repr)
    assert found == brute(rows, 4, 85)


def test_one_of_each_component_stays(spark):
    rows = corpus()
    docs = made(spark, rows)
    kept = jaccard.one_of_each(docs, size=5, percent=80)
    assert kept.columns == docs.columns
    expected = set()
    for (doc_id, n, component), (_, text) in zip(
        sorted(brute(rows, 5, 80), key=repr), sorted(rows, key=lambda r: repr((r[0], len(shingles(r[1], 5)))))
    ):
        if n == 0 or doc_id == component:
            expected.add(doc_id)
    found = [row["doc_id"] for row in kept.collect()]
    assert {n for n in found if n is not None} == {n for n in expected if n is not None}
    assert len([n for n in found if n not in (3, None)]) == len({n for n in found if n not in (3, None)})


def test_no_documents(spark):
    assert jaccard.classes(made(spark, [])).collect() == []
    assert jaccard.one_of_each(made(spark, [])).collect() == []


@settings(max_examples=300, deadline=None)
@given(st.integers(1, 400), st.integers(0, 60), st.integers(0, 60), st.sampled_from([80, 85, 95]), st.randoms())
def test_linked_sets_share_a_window_pivot_in_any_order(common, left, right, percent, rng):
    if 100 * common < percent * (common + left + right):
        return
    numbers = rng.sample(range(10**6), common + left + right)
    frequency = {n: rng.randrange(2, 6) for n in numbers[:common]} | {n: rng.randrange(1, 4) for n in numbers[common:]}
    sets = [numbers[: common + left], numbers[:common] + numbers[common + left :]]
    windows = []
    for own in sets:
        sketch = sorted(own)[: jaccard._sketch_size(len(own), percent)]
        sketch.sort(key=lambda n: (frequency[n], n))
        windows.append(set(sketch[: jaccard._window_size(len(own), percent)]))
    assert windows[0] & windows[1]


def test_components_of_long_chains_and_stars(spark):
    chain = [(n, n + 1) for n in range(60)]
    star = [(1000, n) for n in range(1001, 1060)]
    rng = random.Random(1)
    links = [(a, b) if rng.random() < 0.5 else (b, a) for a, b in chain + star + [(70, 70)]]
    rng.shuffle(links)
    found = dict(map(tuple, components(spark.createDataFrame(links, "a long, b long")).collect()))
    assert found == {n: 0 for n in range(61)} | {n: 1000 for n in range(1000, 1060)}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_hung_finds_the_smallest_reachable(spark):
    import numpy as np

    near = np.eye(5, dtype=bool)
    near[1, 3] = near[3, 1] = near[3, 4] = near[4, 3] = True
    moved, roots = jaccard._hung(near)
    assert (moved.tolist(), roots.tolist()) == ([3, 4], [1, 1])


def test_short_documents_with_a_common_line_share_no_region(spark):
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(6))
    line = " ".join(word() for _ in range(13))
    rows = [(n, " ".join(word() for _ in range(15)) + "\n" + line) for n in range(60)]
    found = jaccard.regions(jaccard.sketches(made(spark, rows)), 85)
    assert found.count() == 0


@settings(max_examples=200, deadline=None)
@given(st.integers(1, 40), st.sampled_from([1, 2, 16]), st.randoms())
def test_linked_equals_all_pairs(count, hubs, rng):
    import numpy as np

    # Copies of copies, so that components are chains and not only stars.
    made = [rng.sample(range(10**6), rng.randrange(1, 60)) for _ in range(rng.randrange(1, 4))]
    while len(made) < count:
        one = set(rng.choice(made))
        for _ in range(rng.randrange(0, len(one) // 8 + 2)):
            one.discard(rng.choice(sorted(one)))
            one.add(rng.randrange(200))
        made.append(sorted(one))
    sets = sorted({tuple(sorted(one)) for one in made})
    rng.shuffle(sets)
    sets = [np.array(one, dtype=np.uint64) for one in sets]
    near = np.array([[100 * len(np.intersect1d(a, b)) >= 85 * len(np.union1d(a, b)) for b in sets] for a in sets])
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(jaccard, "HUBS", hubs, raising=False)
        moved, roots = jaccard.linked(sets)
    expected = jaccard._hung(near)
    assert (moved.tolist(), roots.tolist()) == (expected[0].tolist(), expected[1].tolist())


def test_blocks_of_near_copies_do_not_all_meet(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "MOST_SHINGLES", 6000)
    monkeypatch.setattr(jaccard, "LEAST_WEIGHT", 40)
    monkeypatch.setattr(jaccard, "STAND_INS", 1, raising=False)
    compared, join = [], jaccard._join_places

    def counting(members, sets, percent):
        compared.append(members.count())
        return join(members, sets, percent)

    monkeypatch.setattr(jaccard, "_join_places", counting)
    rng = random.Random(9)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(6))
    base, rows = [word() for _ in range(200)], []
    for n in range(90):
        words = list(base)
        words[rng.randrange(200)] = word()
        rows.append((n, " ".join(words)))
    found = jaccard.classes(made(spark, rows)).collect()
    assert {row["component_id"] for row in found} == {0}
    assert sum(compared) < 2 * len(rows)
