"""Jaccard join, sentence spans, decontamination, packing: against brute force on small fixtures."""

import random
import re

import pytest
from docloom.llm import decontaminate, jaccard_join, packing, sentence_spans

SCHEMA = "doc_id long, text string, key string, pos long, region long"  # the last columns clash with inner names


def table(spark, rows):
    return spark.createDataFrame([(i, t, "k", 1, 2) for i, t in rows], SCHEMA)


def words_of(text):
    return [w.translate({c: c + 32 for c in range(65, 91)}) for w in re.findall(r"[^\x20\x09-\x0D]+", text or "")]


def shingles(text):
    w = words_of(text)
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def components(rows):
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    least = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            least[find(i)] = min(least.get(find(i), doc), doc)
    return sorted((str(doc), len(sets[i]), str(least.get(find(i)))) for i, (doc, _) in enumerate(rows))


def near_copies(seed, bases, copies, length=60, edits=2):
    rng = random.Random(seed)
    rows = []
    for _ in range(bases):
        base = [f"w{rng.randrange(5000)}" for _ in range(length)]
        for _ in range(copies):
            text = list(base)
            for _ in range(rng.randrange(edits + 1)):
                text[rng.randrange(length)] = f"x{rng.randrange(10**6)}"
            rows.append((len(rows), " ".join(text)))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("rows", [
    near_copies(1, 3, 40, edits=3) + [(900, "a b"), (901, "A  b\n"), (902, None), (903, ""), (904, " \t"), (902, None), (None, "a b"), (None, "lone one here"), (905, "x " * 3000)],
    near_copies(2, 40, 2, length=20) + near_copies(3, 1, 5, length=7),
    [(5, "one two three four five six"), (5, "one two three four five six"), (7, "ONE two three four five six")],
    [],
])
def test_jaccard_components(spark, rows):
    got = jaccard_join.jaccard_components(table(spark, rows)).collect()
    assert sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in got) == components(rows)


def test_jaccard_recursion_is_exact_with_tiny_leaves(spark, monkeypatch):
    monkeypatch.setattr(jaccard_join, "LEAF_PAIRS", (0, 0, 3))
    monkeypatch.setattr(jaccard_join, "PIVOTS", (1, 2, 2))
    monkeypatch.setattr(jaccard_join, "FEW", (0, 0, 2))
    rows = near_copies(4, 2, 25, length=50, edits=4)
    got = jaccard_join.jaccard_components(table(spark, rows)).collect()
    assert sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in got) == components(rows)


def test_keep_one(spark):
    rows = [(3, "a b c d e f"), (1, "a b c d e F"), (1, "a b c d e F"), (2, "other words are here now"), (8, None), (9, "")]
    kept = jaccard_join.keep_one(table(spark, rows))
    assert kept.columns == ["doc_id", "text", "key", "pos", "region"]
    assert sorted(r.doc_id for r in kept.collect()) == [1, 2, 8, 9]


def brute_spans(rows):
    """Texts after removing sentences that a non-first span covers."""
    seen, all_spans = {}, []
    for doc, text in rows:
        found, start = [], 0
        tokens = list(re.finditer(r"[^\x20\x09-\x0D]+", text or ""))
        for i, t in enumerate(tokens):
            last = i + 1 == len(tokens)
            if last or t[0][-1] in ".!?" or "\n" in text[t.end():tokens[i + 1].start()]:
                found.append(tokens[start:i + 1])
                start = i + 1
        for i in range(len(found)):
            k, n = i, 0
            while k < len(found) and (k - i < sentence_spans.SENTENCES or n < sentence_spans.WORDS):
                n += len(found[k])
                k += 1
            if k - i >= sentence_spans.SENTENCES and n >= sentence_spans.WORDS:
                key = tuple(t[0].lower() for s in found[i:k] for t in s)
                all_spans.append((doc, text, i, k, key))
    for doc, text, i, _, key in all_spans:
        place = (doc is None, doc or 0, i)
        seen[key] = min(seen.get(key, place), place)
    gone = {}
    for doc, text, i, k, key in all_spans:
        if seen[key] != (doc is None, doc or 0, i):
            gone.setdefault(doc, set()).update(range(i, k))
    return {doc: len(s) for doc, s in gone.items()}


def test_sentence_spans(spark):
    rng = random.Random(3)
    passage = " ".join(f"p{i}" + ("." if i % 13 == 12 else "") for i in range(60)) + "."

    def filler():
        return " ".join(f"f{rng.randrange(10**6)}" + ("." if rng.random() < .2 else "") for _ in range(40))

    rows = [(i, f"{filler()}.\n{passage}\n{filler()}") for i in range(6)] + [(50, passage + "\n" + passage), (60, filler()), (61, None), (62, ""), (None, passage), (63, "One. Two.")]
    got = {r.doc_id: r for r in sentence_spans.dedup_spans(table(spark, rows)).collect()}
    assert {d: r.n_removed for d, r in got.items()} == brute_spans(rows)
    assert 0 not in got and "p5" not in got[1].text and got[None].text == ""
    for doc, text in rows:
        if doc in got:
            cut = text
            for span in reversed(got[doc].spans):
                assert "p" in cut[span.start:span.end]
    assert sentence_spans.dedup_spans(table(spark, [])).count() == 0


def test_short_sentences_at_the_end_of_a_passage(spark):
    passage = " ".join(" ".join(f"s{k}w{i}" for i in range(n)) + "." for k, n in enumerate((30, 9, 10)))
    rows = [(i, f"Own {i} words.\n{passage}\nEnd of number {i}.") for i in range(3)]
    got = {r.doc_id: r for r in sentence_spans.dedup_spans(table(spark, rows)).collect()}
    assert {d: (r.n_removed, r.text) for d, r in got.items()} == {i: (3, f"Own {i} words.\nEnd of number {i}.") for i in (1, 2)}


ITEM = "A train leaves Boston at 9 and travels 120 miles to Albany in 3 hours while another train waits near Boston for passengers who like tea"


def test_leaks(spark):
    other = ITEM.replace("Boston", "Paris").replace("120", "475").replace("Albany", "Lyon").replace("9", "8").replace("3", "2")
    mixed = ITEM.replace("Boston", "Paris", 1)  # one city became another in one place only
    rows = [(1, "so we read: " + ITEM + " and more"), (2, "they say " + other), (3, "they say " + mixed), (4, "nothing of that kind in here at all"),
            (5, None), (6, ""), (2, "they say " + other), (7, ITEM[:60])]
    bench = spark.createDataFrame([(10, ITEM, 1), (11, other, 1), (12, "too short", 1), (13, None, 1), (None, ITEM, 1), (14, "exactly five plain words here", 1)], "item_id long, text string, hash int")
    docs = table(spark, [*rows, (8, "yes exactly five plain words here")])
    leaks = decontaminate.find_leaks(docs, bench)
    got = docs.select("doc_id", decontaminate.text_key().alias("text_key")).join(leaks, "text_key").select("doc_id", "item_id", "verbatim").distinct().collect()
    assert {(r.doc_id, r.item_id, r.verbatim) for r in got} >= {(1, 10, True), (2, 10, False), (8, 14, True)}
    assert {r.doc_id for r in got} <= {1, 2, 3, 8}  # 10 and 11 are one family
    assert {r.item_id for r in got} == {10, 14}
    assert not any(r.doc_id == 3 and r.verbatim for r in got)
    assert decontaminate.find_leaks(docs.limit(0), bench).count() == 0
    assert decontaminate.find_leaks(docs, bench.limit(0)).count() == 0


def test_slots_must_map_one_to_one(spark):
    item = "If Anna has 5 apples then Anna gives 5 apples away so the rest of what Anna had is none at all today"
    same = item.replace("Anna", "Karl").replace("5", "7")
    broken = item.replace("Anna", "Karl").replace("5", "7", 1)
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    docs = table(spark, [(1, "well " + same), (2, "well " + broken)])
    leaks = decontaminate.find_leaks(docs, bench)
    got = docs.select("doc_id", decontaminate.text_key().alias("text_key")).join(leaks, "text_key").collect()
    assert [r.doc_id for r in got] == [1]


def leaked(spark, docs, items):
    docs = table(spark, docs)
    leaks = decontaminate.find_leaks(docs, spark.createDataFrame(items, "item_id long, text string"))
    return {(r.doc_id, r.item_id, r.verbatim) for r in docs.select("doc_id", decontaminate.text_key().alias("text_key")).join(leaks, "text_key").collect()}


def test_equal_slots_far_apart_part_families(spark):
    item = "So Sam has {} red apples in the old basket by the kitchen door and later on buys {} more of them at the market near home"
    for one, two in (((5, 5), (4, 9)), ((4, 9), (5, 5))):
        got = leaked(spark, [(1, "well " + item.format(*two))], [(1, item.format(*one)), (2, item.format(*two)), (3, item.format(*(x + 20 for x in two)))])
        assert got == {(1, 2, True)}  # 3 has the pattern of 2 and is in its family


def test_copies_of_items_poor_in_plain_words(spark):
    total, names = "Compute 17 * 24 + 305 / 5 - 12", "Meet Anna Berg, Carl Dahl, Emma Falk, Gustav Holm, Ida Juhl, Karl Lund, Maria Nord, Otto Palm, Rosa Smed and 12 others"
    items = [(1, total), (2, total.replace("17", "18")), (3, names)]
    docs = [(1, "first: " + total + " at once"), (2, "then " + total.replace("24", "25")), (3, "we " + names), (4, "we " + names.replace("Emma", "Lisa").replace("Karl", "Lars").replace("Rosa", "Anna")), (5, "so " + items[1][1])]
    assert leaked(spark, docs, items) == {(1, 1, True), (3, 3, True), (5, 2, True)}


def naive_best_fit(sizes, sources, clusters, capacity):
    bins, out = [], []
    for size, source, cluster in zip(sizes, sources, clusters, strict=True):
        fits = [(capacity - used, i) for i, (used, s, c) in enumerate(bins) if used + size <= capacity and source not in s and (cluster < 0 or cluster not in c) and used < capacity]
        if fits:
            i = min(fits)[1]
        else:
            i = len(bins)
            bins.append([0, set(), set()])
        out.append((i, bins[i][0]))
        bins[i][0] += size
        bins[i][1].add(source)
        bins[i][2].add(cluster)
    return out


def test_best_fit_is_the_tightest_compatible_bin():
    rng = random.Random(5)
    for _ in range(30):
        n = rng.randrange(1, 120)
        sizes = sorted((rng.randrange(1, 50) for _ in range(n)), reverse=True)
        sources, clusters = [rng.choice([0, 0, 1, 2, 3]) for _ in range(n)], [rng.randrange(-1, 10) for _ in range(n)]
        assert list(zip(*packing.best_fit(sizes, sources, clusters, 50), strict=True)) == naive_best_fit(sizes, sources, clusters, 50)


def test_packing(spark):
    rng = random.Random(6)
    rows = [(i, " ".join(["w%d" % rng.randrange(99)] * rng.randrange(1, 900)), "hot" if i % 3 == 0 else f"s{i % 7}") for i in range(300)]
    rows += [(900, "long " * 5000, "s1"), (901, None, "s1"), (902, "", None), (None, "a  B\nc", None), (903, "a b c", "s9"), (903, "a b c", "s9")]
    docs = spark.createDataFrame([(*r, 7) for r in rows], "doc_id long, text string, source string, bin_id int")
    got = packing.pack_documents(docs).collect()
    want = {}
    for doc, text, _ in rows:
        want[doc] = want.get(doc, 0) + len((text or "").split())
    total, bins = {}, {}
    for r in got:
        total[r.doc_id] = total.get(r.doc_id, 0) + r.n_words
        if r.n_words:
            bins.setdefault(r.bin_id, []).append(r)
        else:
            assert r.bin_id is None
    assert total == want
    for members in bins.values():
        members.sort(key=lambda r: r.bin_offset)
        assert members[0].bin_offset == 0 and all(a.bin_offset + a.n_words == b.bin_offset for a, b in zip(members, members[1:], strict=False))
        assert sum(r.n_words for r in members) <= packing.CAPACITY
        assert len({r.source for r in members}) == len(members) == len({r.cluster for r in members})
    assert packing.pack_documents(docs.limit(0)).count() == 0
