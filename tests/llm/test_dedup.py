"""Near duplicates, repeated passages and similar lines against brute force."""

import re
from collections import defaultdict

import pyarrow as pa
import pytest
from llm_making import SF, documents, odd_documents
from pyspark.sql import functions as F

from meterlake.llm import arrays, buckets, line_dedup, near_dedup
from meterlake.llm.line_dedup import dedup_lines, dropped_lines, similar_lines, line_rows
from meterlake.llm.near_dedup import classify, keep_one
from meterlake.llm.shared import components, packed, settled, ship_package
from meterlake.llm.suffix_dedup import cut_repeats, extended

SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def docs(spark):
    ship_package(spark)
    return spark.read.parquet(f"{SF01}/documents.parquet").select("doc_id", "text").repartition(3).cache()


@pytest.fixture(scope="module")
def texts(docs):
    return dict(sorted((r.doc_id, r.text) for r in docs.collect()))


class Union:
    def __init__(self):
        self.up = {}

    def find(self, x):
        while self.up.setdefault(x, x) != x:
            x = self.up[x]
        return x

    def join(self, a, b):
        a, b = sorted((self.find(a), self.find(b)))
        self.up[b] = a


def profiles(texts):
    out = {}
    for i, text in texts.items():
        h, _, c = near_dedup.shingles(*near_dedup.word_hashes(*arrays.column_bytes(pa.array([text], pa.string()))), 1)
        out[i] = dict(zip(h.tolist(), near_dedup.weights(c).tolist()))
    return out


def plain_similarity(v, w):
    total = 0.0
    for d in v.keys() & w.keys():
        total += 1 / sum(max(v.get(e, 0) / v[d], w.get(e, 0) / w[d]) for e in v.keys() | w.keys())
    return total


def test_exact_similarity_equals_its_definition():
    import numpy as np

    random = np.random.default_rng(3)
    for _ in range(60):
        a, b = (np.sort(random.choice(30, random.integers(1, 25), replace=False)) for _ in range(2))
        v, w = (near_dedup.weights(random.integers(1, 6, len(x))) for x in (a, b))
        expected = plain_similarity(dict(zip(a.tolist(), v)), dict(zip(b.tolist(), w)))
        assert abs(near_dedup.probability_jaccard(a, v, b, w) - expected) < 1e-9


def test_signatures_estimate_the_similarity():
    import numpy as np

    random = np.random.default_rng(4)
    base = random.integers(0, 2**63, 400).astype(np.uint64)
    other = np.concatenate([base[:300], random.integers(0, 2**63, 100).astype(np.uint64)])
    counts = random.integers(1, 4, 400)
    weight = near_dedup.weights(counts)
    hashes, owner = np.concatenate([base, other]), np.repeat([0, 1], 400)
    drawn = near_dedup.signatures(hashes, owner, np.concatenate([weight, weight]), 2, 2000)
    a, b = ((x[o], weight[o]) for x, o in ((x, np.argsort(x)) for x in (base, other)))
    assert abs((drawn[0] == drawn[1]).mean() - near_dedup.probability_jaccard(*a, *b)) < 0.05


def test_near_duplicate_classes_equal_brute_force(docs, texts):
    union, by_shingle = Union(), defaultdict(list)
    held = profiles(texts)
    for i, v in held.items():
        union.find(i)
        shared = defaultdict(int)
        for s in v:
            for j in by_shingle[s]:
                shared[j] += 1
            by_shingle[s].append(i)
        for j, n in shared.items():
            if n >= 0.5 * min(len(v), len(held[j])) and union.find(i) != union.find(j) and plain_similarity(v, held[j]) >= 0.8 - 1e-9:
                union.join(i, j)
    got = classify(docs).collect()
    assert {r.doc_id: r.class_id for r in got} == {i: union.find(i) for i in texts}
    assert all(r.is_kept == (r.doc_id == r.class_id) for r in got)


def test_a_large_group_of_copies_and_near_copies_is_one_class(spark):
    base = [f"w{i}" for i in range(400)]
    rows = [(i, " ".join(base)) for i in range(300)]
    for i in range(300, 500):  # each differs from the base in one place, so two of them differ in two
        words = list(base)
        words[(i * 7) % 400] = f"x{i}"
        rows.append((i, " ".join(words)))
    rows += [(500 + i, " ".join(f"y{i}_{j}" for j in range(50))) for i in range(100)]
    got = {r.doc_id: r.class_id for r in classify(documents(spark, rows).repartition(4)).collect()}
    assert {got[i] for i in range(500)} == {0} and all(got[i] == i for i in range(500, 600))


def test_components(spark):
    links = [(i, i + 1) for i in range(60)] + [(100, 101), (101, 102), (200, 200), (7, 3)] + [(300, 300 + i) for i in range(1, 50)]
    df = spark.createDataFrame([*links, (None, 1)], "a long, b long")
    got = {r.node: r.root for r in components(df).collect()}
    assert got == {**{i: 0 for i in range(61)}, **{i: 100 for i in (100, 101, 102)}, **{i: 300 for i in range(300, 350)}}


def test_components_equal_plain_union_find(spark):
    from random import Random

    random = Random(11)
    graphs = [[(1, 5), (2, 5)], [(5, 1), (3, 1), (6, 2), (3, 2)]]  # V-shaped links, and links that settle late
    for _ in range(60):  # stars around the largest node, stars around any node, random graphs
        graphs.append([(leaf, 9) for leaf in random.sample(range(9), random.randint(2, 6))])
        nodes = random.sample(range(10), random.randint(3, 7))
        graphs.append([(nodes[0], leaf) for leaf in nodes[1:]])
        size = random.randint(3, 12)
        graphs.append([(random.randrange(size), random.randrange(size)) for _ in range(random.randint(2, size))])
    links = [(100 * g + a, 100 * g + b) for g, graph in enumerate(graphs) for a, b in graph]
    union = Union()
    for a, b in links:
        if a != b:
            union.join(a, b)
    # Each graph by itself, so that one that is not settled doesn't give the others further rounds.
    for graph in ([(1, 5), (2, 5)], [(5, 1), (3, 1), (6, 2), (3, 2)]):
        got = {r.node: r.root for r in components(spark.createDataFrame(graph, "a long, b long")).collect()}
        assert set(got.values()) == {1}
    got = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {x: union.find(x) for x in list(union.up)}


def test_near_dedup_of_odd_and_empty_tables(spark):
    odd = odd_documents(spark)
    kept = keep_one(odd)
    assert kept.columns == odd.columns and classify(odd).count() == odd.count()
    # Null, empty and blank texts: null counts as empty, other texts without words as themselves.
    without = [r.text for r in kept.collect() if not re.search(r"\w", r.text or "")]
    assert len(without) == len(set(t or "" for t in without))
    assert sum(r.text == "a" for r in kept.collect()) == 1
    assert keep_one(odd.limit(0)).count() == 0


def repeated_words(texts, least=50):
    """Words of each text that an earlier place holds too, of whole passages of the least length."""
    first, out = {}, {}
    for i, text in texts.items():
        w = [x for x in re.split(r"[\t\n\x0b\x0c\r\x1c-\x20]+", text or "") if x]
        gone = [False] * len(w)
        for p in range(len(w) - least + 1):
            d, q = first.setdefault(tuple(w[p : p + least]), (i, p))
            if d != i or p - q >= least:
                gone[p : p + least] = [True] * least
        out[i] = (w, gone)
    return out


def test_repeated_passages_equal_brute_force(docs, texts):
    expected = repeated_words(texts)
    got = {r.row.doc_id: r for r in cut_repeats(docs).collect()}
    assert got.keys() == texts.keys()
    some = 0
    for i, (w, gone) in expected.items():
        left = [x for x, g in zip(w, gone) if not g]
        periodic = len(set(w)) < len(w) / 3
        some += sum(gone)
        if periodic:  # positions are thinned where few words repeat over and over
            assert got[i].words_cut <= sum(gone)
        else:
            assert (got[i].text or "").split() == left, i
    assert some > 0


def test_planted_passages_are_cut_once(spark):
    from random import Random

    random = Random(5)
    fresh = lambda n: " ".join(f"v{random.randrange(10**9)}" for _ in range(n))
    passage = fresh(60)
    rows = [(i, f"{fresh(random.randrange(1, 200))}\n{passage}  {fresh(random.randrange(1, 200))}") for i in range(150)]
    rows += [(1000 + i, fresh(120)) for i in range(50)]
    got = {r.row.doc_id: r for r in cut_repeats(documents(spark, rows).repartition(4)).collect()}
    assert got[0].words_cut == 0 and all(got[i].words_cut == 60 for i in range(1, 150))
    assert all(got[1000 + i].text == rows[150 + i][1] for i in range(50))
    assert got[3].text == rows[3][1].replace(f"{passage}  ", "")


def test_passages_around_a_frequent_core_equal_brute_force(spark):
    from random import Random

    random = Random(12)
    fresh = lambda n: [f"v{random.randrange(10**9)}" for _ in range(n)]
    rows = []
    for core in range(6):  # a core of many texts, whose rims are shared by two of them each
        middle = fresh(random.choice((40, 44, 48)))
        for _ in range(12):
            left, right = fresh(2), fresh(52 - 2 - len(middle))
            rows += [fresh(70) + left + middle + right + fresh(70) for _ in range(2)]
    random.shuffle(rows)
    rows = [(i, " ".join(words)) for i, words in enumerate(rows)]
    expected = repeated_words(dict(rows))
    got = {r.row.doc_id: r for r in cut_repeats(documents(spark, rows).repartition(4)).collect()}
    assert sum(sum(gone) for _, gone in expected.values()) == 6 * 12 * 52
    for i, (w, gone) in expected.items():
        assert got[i].text.split() == [x for x, g in zip(w, gone) if not g], i


def test_a_rearranged_passage_is_followed_beyond_what_is_covered():
    import numpy as np

    p, r, other = np.arange(60), np.arange(100, 120), np.arange(200, 250)
    late, early = np.concatenate([p, r]), np.concatenate([p[30:], r, other, p])
    shifts, ats = np.array([-100, 30, 30]), np.array([5, 30, 45])
    assert extended(late, early, shifts, ats, 50) == [(0, 60), (30, 80)]
    # What ends inside of a covered stretch adds nothing.
    assert extended(p, np.concatenate([p[:52], other, p]), np.array([-102, 0]), np.array([5, 5]), 50) == [(0, 60)]


def test_passages_of_odd_and_empty_tables(spark):
    odd = odd_documents(spark)
    cut = cut_repeats(odd)
    assert cut.count() == odd.count() and cut.select("row.*").columns == odd.columns
    assert cut.where("row.text is null and text is not null").count() == 0
    assert cut_repeats(odd.limit(0)).count() == 0


def shingle_set(line):
    return {line[i : i + 5] for i in range(len(line) - 4)} if len(line) >= 5 else {line}


def test_lines_equal_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    texts = dict(sorted((r.doc_id, r.text) for r in docs.collect()))
    lines = {}
    for i, text in texts.items():
        for at, line in enumerate((text or "").split("\n")):
            if line.strip():
                lines.setdefault(line, (i, at))
    union, by_shingle, sets = Union(), defaultdict(list), {x: shingle_set(x) for x in lines}
    for x, v in sets.items():
        union.find(lines[x])
        shared = defaultdict(int)
        for s in v:
            for y in by_shingle[s]:
                shared[y] += 1
            by_shingle[s].append(x)
        for y, n in shared.items():
            if n >= 0.8 * (len(v) + len(sets[y]) - n):
                union.join(lines[x], lines[y])
    got = {r.row.doc_id: r for r in dedup_lines(docs).collect()}
    cut = missed = 0
    for i, text in texts.items():
        first = lambda at, line: not line.strip() or union.find(lines[line]) == (i, at)
        kept = [line for at, line in enumerate((text or "").split("\n")) if first(at, line)]
        left = got[i].text.split("\n") if kept else []
        # Bands may miss a pair at the very threshold; every line that goes must have a reason.
        rest = iter(left)
        assert all(line in rest for line in kept), i
        missed += len(left) - len(kept)
        cut += got[i].lines_cut
    assert cut > 200 and missed <= 0.01 * cut


def lines_of(spark, texts):
    return spark.createDataFrame([(x,) for x in sorted(set(texts))], "line string").selectExpr("xxhash64(line) as lh", "line")


def linked_lines(lines):
    """Component of each line, by the text of its smallest hash."""
    held = {r.lh: r.line for r in lines.collect()}
    roots = {r.node: r.root for r in similar_lines(lines, 0.8).collect()}
    return {line: roots.get(lh, lh) for lh, line in held.items()}


def test_short_lines_with_one_edit_meet(spark):
    from random import Random

    random = Random(13)
    pairs = []
    while len(pairs) < 1500:
        words = ["".join(random.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(random.randint(2, 9))) for _ in range(random.randint(1, 14))]
        line, at = " ".join(words), random.randrange(len(words))
        typo = random.randrange(len(line))
        other = random.choice((line[:typo] + "Q" + line[typo + 1 :], " ".join(words[:at] + words[at + 1 :]), line + "!", line[1:]))
        a, b = shingle_set(line), shingle_set(other)
        if line != other and other.strip() and len(a & b) >= 0.8 * len(a | b):
            pairs.append((line, other))
    got = linked_lines(lines_of(spark, [x for pair in pairs for x in pair]))
    for least, most in ((0, 20), (20, 40), (40, 60), (60, 200)):
        some = [got[a] == got[b] for a, b in pairs if least <= len(a) < most]
        assert len(some) > 50 and sum(some) >= 0.999 * len(some), (least, sum(some), len(some))


def test_pairs_in_a_family_of_unlike_lines_meet(spark):
    from random import Random

    random = Random(14)
    mark = lambda n: "".join(random.choice("abcdefghijklmnopqrstuvwxyz0123456789") for _ in range(n))
    template, pairs = mark(64), []
    for _ in range(150):  # lines that share a part with the whole family, and are similar to one other only
        line = template + mark(26)
        pairs.append((line, line[:-3] + mark(3)))
    got = linked_lines(lines_of(spark, [x for pair in pairs for x in pair]))
    assert all(got[a] == got[b] for a, b in pairs) and len(set(got.values())) == 150


def test_long_lines_that_differ_are_ruled_out_unread(spark, monkeypatch):
    """Lines with three fifths of their shingles in common share buckets, but hardly any pair has its texts compared."""
    from random import Random

    random = Random(15)
    mark = lambda n: "".join(random.choice("abcdefghijklmnopqrstuvwxyz0123456789") for _ in range(n))
    template = mark(1125)
    texts = [template + mark(375) for _ in range(40)]
    texts.append(texts[0][:-20] + mark(20))
    compared, verified = [], line_dedup._verified

    def counted(pairs, *others):
        compared.append(pairs.count())
        return verified(pairs, *others)

    monkeypatch.setattr(line_dedup, "_verified", counted)
    got = linked_lines(lines_of(spark, texts))
    assert len(set(got.values())) == 40 and got[texts[0]] == got[texts[40]]
    assert 1 <= sum(compared) <= 20


def test_buckets_are_found_some_bands_at_a_time(spark, monkeypatch):
    lines = line_rows(packed(spark.read.parquet(f"{SF}/documents.parquet")))
    drawn = settled(line_dedup.line_sketches(lines))
    held, kept = defaultdict(set), line_dedup.settled
    for r in drawn.collect():
        for bucket in r.bands:
            held[bucket].add(r.lh)

    def watched(df):
        plan = df._jdf.queryExecution().analyzed().toString()
        assert not re.search(r"explode\(bands", plan)
        return kept(df)

    monkeypatch.setattr(line_dedup, "settled", watched)
    got = [(r.bucket, r.key) for r in line_dedup.bucket_members(drawn).collect()]
    assert len(got) == len(set(got)) > 100
    assert set(got) == {(b, key) for b, keys in held.items() if len(keys) > 1 for key in keys}
    similar_lines(lines, 0.8)


def test_a_pair_that_shares_several_buckets_is_looked_at_once(spark, monkeypatch):
    from random import Random

    random = Random(16)
    mark = lambda n: "".join(random.choice("abcdefghijklmnopqrstuvwxyz0123456789") for _ in range(n))
    template, made, between = mark(256), [], buckets._all_between
    texts = [template + mark(104) for _ in range(150)]  # marks can't rule all of these pairs out
    monkeypatch.setattr(line_dedup, "MARK_WORDS", 1)

    def counted(*given):
        pairs = between(*given)
        made.append((pairs.count(), pairs.distinct().count()))
        return pairs

    monkeypatch.setattr(buckets, "_all_between", counted)
    linked_lines(lines_of(spark, texts))
    assert made and all(n == different > 50 for n, different in made)


def test_shingles_are_held_for_a_piece_of_the_lines_at_a_time(spark, monkeypatch):
    from random import Random

    random, held, shingles = Random(17), [], line_dedup.line_shingles
    text = pa.array(["".join(random.choice("abcdefgh ") for _ in range(400)) for _ in range(4000)])
    batch = pa.RecordBatch.from_arrays([pa.array(range(4000)), pa.array(range(4000)), text, text], names=["a", "b", "text", "other"])

    def counted(codes, at):
        held.append(len(codes))
        return shingles(codes, at)

    class Rows:  # what a task is given
        def mapInArrow(self, task, schema):
            return pa.Table.from_batches(task(iter([batch])))

    monkeypatch.setattr(line_dedup, "line_shingles", counted)
    monkeypatch.setattr(line_dedup, "masked", lambda rows, *_: rows)
    monkeypatch.setattr(line_dedup, "mask_of", lambda *_: None)
    for name in ("join", "select"):
        setattr(Rows, name, lambda self, *_: self)
    rows = Rows()
    rows.unionByName = lambda other: rows
    assert line_dedup._verified(rows, rows, 0.8).num_rows == 4000
    assert sum(held) == 2 * 400 * 4000 and max(held) <= line_dedup.SHINGLE_BYTES


def test_line_dedup_keeps_one_of_each_kind(spark):
    base = "The quick brown fox jumps over the lazy dog while seven wizards watch from the old stone tower "
    base += "and the river below it carries boats with lanterns to the harbour of the quiet city"
    near = [base.replace("seven", f"{n} tall") for n in ("nine", "five")]
    rows = [(3, f"{base}\nown line three\n\n"), (1, f"own line one\n{near[0]}"), (2, f"{near[1]}\n{base}"), (None, base), (4, None), (5, "")]
    got = {r.row.doc_id: r for r in dedup_lines(documents(spark, rows)).collect()}
    assert got[1].text == f"own line one\n{near[0]}" and got[2].text == "" and got[3].text == "own line three\n\n"
    assert got[None].text == "" and got[4].text is None and got[5].text == "" and got[2].lines_cut == 2


def test_only_signatures_leave_dataframe_functions(spark):
    """The native form fails the limits of the check tool (README); only shingles are drawn and compared in numpy."""
    source = packed(spark.read.parquet(f"{SF}/documents.parquet"))
    for df in (line_rows(source), dropped_lines(source), dedup_lines(spark.read.parquet(f"{SF}/documents.parquet"))):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert not re.search("Python|Arrow|Pandas|MapIn", plan)


def test_signatures_agree_as_often_as_lines_are_alike():
    import numpy as np

    random = np.random.default_rng(8)
    letters = list("abcdefghijklmnopqrstuvwxyzäöü ")
    for length in (3, 12, 40, 200, 900):
        lines = []
        for _ in range(300):
            a = list(random.choice(letters, length))
            b = list(a)
            for at in random.choice(length, max(1, length // 60)):
                b[at] = "Q"
            lines += ["".join(a), "".join(b)]
        codes = np.array([ord(c) for line in lines for c in line], np.uint32)
        drawn, size = line_dedup.line_signatures(codes, np.append(0, np.cumsum([len(x) for x in lines])))
        assert size.tolist() == [max(1, len(x) - 4) for x in lines]
        found = (drawn[::2] == drawn[1::2]).mean()
        sets = [shingle_set(x) for x in lines]
        exact = np.mean([len(a & b) / len(a | b) for a, b in zip(sets[::2], sets[1::2])])
        assert abs(found - exact) < 0.03, (length, found, exact)


def test_lines_of_odd_and_empty_tables(spark):
    odd = odd_documents(spark)
    cut = dedup_lines(odd)
    assert cut.count() == odd.count() and cut.select("row.*").columns == odd.columns
    assert dedup_lines(odd.limit(0)).count() == 0


def test_long_texts_words_and_lines(spark):
    """Texts beyond a piece of a batch, a line beyond it, and words whose hashes agree modulo powers of two."""
    from random import Random

    random = Random(21)
    a, b = "a", "b"
    while len(a) < 2048:
        a, b = a + b, b + a
    words = [f"w{random.randrange(10**6)}" for _ in range(400_000)]
    text = " ".join(words)
    assert len(text) > arrays.PIECE_BYTES
    other = " ".join(words[:-1000])
    rows = [(1, text), (2, other), (3, " ".join([a] * 60)), (4, " ".join([b] * 60)), (5, f"{text}\nshort")]
    df = documents(spark, rows).repartition(2)
    got = {r.doc_id: r.class_id for r in classify(df).collect()}
    assert got == {1: 1, 2: 1, 3: 3, 4: 4, 5: 1}
    lines = {r.row.doc_id: (r.text, r.lines_cut) for r in dedup_lines(df).collect()}
    assert lines[1] == (text, 0) and lines[2] == ("", 1) and lines[5] == ("short", 1)
    cut = {r.row.doc_id: r for r in cut_repeats(df).collect()}
    assert cut[1].words_cut == 0 and cut[2].words_cut == 399_000 and cut[5].text == "short" and cut[4].text.split()[:1] == [b]


def test_copies_of_whole_texts_are_cut(spark):
    short, long = " ".join(f"a{i}" for i in range(40)), " ".join(f"b{i}" for i in range(70))
    rows = [(i + j, t) for i in range(0, 300, 3) for j, t in enumerate((long, short, f"{long} c{i + 2}"))]
    rows += [(None, long), (None, ""), (1000, None)]
    got = [(r.row.doc_id, r.row.text, r.text, r.words_cut, r.spans) for r in cut_repeats(documents(spark, rows).repartition(5)).collect()]
    for i, before, after, n, spans in got:
        if before in (short, None, "") or (i == 0 and before == long):
            assert after == before and n == 0 and spans is None
        elif before == long:
            assert after == "" and n == 70 and [(s.begin, s.end) for s in spans] == [(0, 70)]
        else:
            assert after.strip() == f"c{i}" and n == 70


def test_a_hot_bucket_of_many_pairs(spark):
    """Texts that share most of their words with all others, and enough to be alike with one of them only."""
    from random import Random

    random = Random(22)
    fresh = lambda n: [f"v{random.randrange(10**9)}" for _ in range(n)]
    frame, rows = fresh(300), []
    for i in range(60):
        own = fresh(100)
        rows += [(2 * i, " ".join(frame + own)), (2 * i + 1, " ".join(frame + own[:-18] + fresh(18)))]
    got = {r.doc_id: r.class_id for r in classify(documents(spark, rows).repartition(4)).collect()}
    import numpy as np

    held = {i: (np.array(sorted(v), np.uint64), np.array([v[s] for s in sorted(v)])) for i, v in profiles(dict(rows)).items()}
    union = Union()
    for i in held:
        union.find(i)
        for j in range(i):
            if near_dedup.probability_jaccard(*held[i], *held[j]) >= 0.8 - 1e-9:
                union.join(i, j)
    assert got == {i: union.find(i) for i in held} and len(set(got.values())) == 60


def test_all_pairs_of_a_bucket_meet_whatever_its_order(spark, monkeypatch):
    """Each member is like one other, which neither turns nor their orders bring together; blocks are small."""
    monkeypatch.setattr(buckets, "BLOCK", 16)
    monkeypatch.setattr(buckets, "PAIRS_A_MEMBER", 1)
    half = 60
    rows = [(b, k, 2 * half) for b in (1, 2) for k in range(2 * half)] + [(3, k, 2) for k in (1000, 1001)]
    members = settled(spark.createDataFrame(rows, "bucket long, key long, company long"))
    marks = members.select("key").distinct().selectExpr("key", "1 AS size", "array(0L) AS marks")

    def verify(pairs, few):
        return pairs.where(f"b - a = {half} or (a < 5 and b = a + 1) or a = 1000")

    def turned(unsettled, number):
        return unsettled.withColumn("turned", F.col("key"))

    got = {r.node: r.root for r in buckets.linked(members, settled(marks), 1, lambda x, y: x + y, verify, turned).collect()}
    want = {k: 0 if k % half < 6 else k % half for k in range(2 * half)} | {1000: 1000, 1001: 1000}
    assert got == want


def test_marks_rule_out_no_pair_that_is_alike(spark):
    import numpy as np

    random = np.random.default_rng(21)
    for similarity in (0.6, 0.8, 0.9):
        for size in (1, 4, 30, 300):
            for _ in range(60):
                words = random.choice(["w%d" % i for i in range(3 * size)], size + 4).tolist()
                other = [w if random.random() > 0.1 / size**0.5 else "x%d" % random.integers(99) for w in words]
                texts = pa.array([" ".join(words), " ".join(other)], pa.string())
                h, of, count = near_dedup.shingles(*near_dedup.word_hashes(*arrays.column_bytes(texts)), 2)
                weight = near_dedup.weights(count)
                x, y = of == 0, of == 1
                alike = near_dedup.probability_jaccard(h[x], weight[x], h[y], weight[y])
                marks = np.array(buckets.parities(h, of, 2, near_dedup.MARK_WORDS).values.to_numpy()).view(np.uint64).reshape(2, -1)
                differing = int(np.bitwise_count(marks[0] ^ marks[1]).sum())
                assert differing <= len(set(h[x].tolist()) ^ set(h[y].tolist()))
                if alike >= similarity:
                    assert differing <= max(weight[x].sum(), weight[y].sum()) * near_dedup.most_apart(similarity) + 1e-6


def test_passages_hold_little_memory_at_a_time(spark):
    """However many texts a batch has, numpy holds numbers for the words of a few of them."""
    import tracemalloc

    from meterlake.llm import suffix_dedup, toxicity

    class Rows:  # what a task is given
        tasks = []

        def mapInArrow(self, task, schema):
            self.tasks.append(task)
            return self

    for name in ("select", "where", "withColumn"):
        setattr(Rows, name, lambda self, *_: self)
    text = [" ".join(f"w{(i * 7919 + j * j) % 100_003}" for j in range(400)) for i in range(6000)]
    column, number = pa.array(text), pa.array(range(6000))
    suffix_dedup.suffixes(Rows(), 50)
    near_dedup.sketch(Rows(), 24, 5)
    toxicity.terms_of(Rows())
    batch = pa.RecordBatch.from_arrays([number, number, number, column], names=["doc_id", "r1", "r2", "text"])
    assert batch.nbytes > 2 * arrays.PIECE_BYTES and len(Rows.tasks) == 3
    for task in Rows.tasks:
        arrays._POWERS.clear()
        arrays._PRIME_POWERS.clear()
        tracemalloc.start()
        assert sum(out.num_rows for out in task(iter([batch]))) >= 6000
        most = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert most < 40 << 20, (task.__qualname__, most)


def test_rows_that_may_change_are_shuffled_with_one_text(spark):
    """Their text is in `row`; a second copy would double the shuffle and every batch that is made of it."""
    words = " ".join(f"w{i}" for i in range(80))
    df = documents(spark, [(1, f"{words} a"), (2, f"{words} b"), (3, f"own line of text\n{words} a"), (4, None)])

    def joined(node):
        if node.nodeName() == "Join":
            yield {side.output().apply(i).name() for side in (node.left(), node.right()) for i in range(side.output().size())}
        for i in range(node.children().size()):
            yield from joined(node.children().apply(i))

    for cut in (cut_repeats, dedup_lines):
        names = [x for x in joined(cut(df)._jdf.queryExecution().optimizedPlan()) if "row" in x and x & {"spans", "gone"}]
        assert len(names) == 1 and "text" not in names[0]
    assert [r.words_cut for r in cut_repeats(df).orderBy("row.doc_id").collect()] == [0, 80, 81, 0]


def test_a_text_is_split_once_to_take_lines_out(spark):
    import time

    n = 40_000
    rows = [("\n".join(f"line {i}" for i in range(n)), list(range(0, n, 2))), ("a\nb\n\nc\n", [3, 1]), ("a", [0]), ("é\n😀", [0])]
    df = spark.createDataFrame(rows, "text string, gone array<int>")
    began = time.time()
    got = [r[0] for r in df.select(line_dedup.without_lines(F.col("text"), F.col("gone"))).collect()]
    assert got == ["\n".join(f"line {i}" for i in range(1, n, 2)), "a\n\n", "", "😀"]
    assert time.time() - began < 20


def test_shingles_of_short_and_long_lines_are_their_own():
    """A line has the same shingles whatever stands beside it."""
    lines = ["", "a", "ab", "abc", "abcd", "abcde", "日本語", "日本語テスト", "😀", "", "abcd", "aaaaaaaaaaaaa", "x"]
    alone = [line_dedup.line_shingles(*line_dedup.code_points(pa.array([x]))) for x in lines]
    h, owner, size = line_dedup.line_shingles(*line_dedup.code_points(pa.array(lines)))
    assert size.tolist() == [max(len(x) - 4, min(len(x), 1)) for x in lines] == [int(s[0]) for _, _, s in alone]
    for i, (own, _, _) in enumerate(alone):
        assert h[owner == i].tolist() == own.tolist() and len(set(own.tolist())) == len(shingle_set(lines[i]) if lines[i] else [])
    assert len({int(own[0]) for own, _, _ in alone[1:9]}) == 8


def test_blank_lines_are_those_of_white_space(spark):
    text = "\n".join(["", " ", "\t \x0b\f\r", "\xa0", " a", "\u2003", "b "])
    got = sorted(r["at"] for r in line_rows(packed(documents(spark, [(1, text)]))).collect())
    assert got == [3, 4, 5, 6]
