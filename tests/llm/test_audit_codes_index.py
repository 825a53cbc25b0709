"""Filter audit, vector codes and the multi-index against their plain forms."""

import hashlib
import itertools
import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from mergeloom.llm import filter_audit, multi_index, queries, vector_codes
from mergeloom.llm.common import load

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


# --- 11: filter audit ---------------------------------------------------------------------------

def plain_mask(text, copy):
    words = [w for w in re.split("[\x20\x09-\x0D]+", text) if w]
    return ((len(words) < 50) + 2 * (100 * len(set(words)) < 65 * len(words))
            + 4 * (100 * len(re.findall("[A-Z]", text)) > 5 * len(text)) + 8 * bool(re.search("[#$%&*|]", text)) + 16 * copy)


def plain_audit(docs, labels):
    """Every order applied to every document; rows as the query returns them."""
    docs = [(i, t or "", s or "") for i, t, s in docs]
    least = {}
    for i, t, _ in docs:
        if i is not None:
            least[t] = min(least.get(t, i), i)
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, x in labels if x == 1 and i is not None}
    parts = {}
    for i, t, s in docs:
        parts.setdefault(s, []).append((plain_mask(t, i is not None and i > least[t]), i in good, i in toxic))
    rows = []
    for part, held in parts.items():
        removed_by = Counter()
        own = []
        for order in itertools.permutations(range(5)):
            left = held
            for step, f in enumerate(order, 1):
                gone = [d for d in left if d[0] >> f & 1]
                left = [d for d in left if not d[0] >> f & 1]
                removed_by[f] += len(gone)
                own.append((part, "".join("ABCDE"[x] for x in order), step, f, len(left), len(gone),
                            sum(d[0] >> f & 1 for d in held) - len(gone), sum(d[0] == 1 << f for d in held),
                            sum(d[1] for d in gone), sum(d[2] for d in gone)))
        rows += [(p, o, st, k, r, red, u, g, x, removed_by[f]) for p, o, st, f, k, r, red, u, g, x in own]
    return sorted(rows)


def audited(docs, labels):
    got = filter_audit.filter_audit(docs, labels)
    return sorted(tuple(r) for r in got.select("part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails",
                                               "good_lost", "toxic_lost", "shapley").collect())


def test_swaps_lead_through_every_order():
    for k in range(1, 7):
        order, seen = list(range(k)), {tuple(range(k))}
        for s in filter_audit.adjacent_swaps(k):
            order[s], order[s + 1] = order[s + 1], order[s]
            seen.add(tuple(order))
        assert len(seen) == math.factorial(k) == len(filter_audit.adjacent_swaps(k)) + 1


def test_swapped_diagram_equals_one_built_in_that_order():
    r = random.Random(5)
    counts = {m: (r.randrange(4), r.randrange(2)) for m in range(16)}
    diagram = filter_audit.Diagram(counts, 4, 2)
    for s in filter_audit.adjacent_swaps(4):
        diagram.swap(s)
        turned = {sum((m >> f & 1) << i for i, f in enumerate(diagram.order)): w for m, w in counts.items()}
        fresh = filter_audit.Diagram(turned, 4, 2)
        assert [x[1:] for x in diagram.steps()] == [x[1:] for x in fresh.steps()]
        assert [len(t) for t in diagram.levels] == [len(t) for t in fresh.levels]  # as reduced as a new one


def test_equal_subdiagrams_are_held_once():
    diagram = filter_audit.Diagram({m: (1,) for m in range(32)}, 5, 1)
    assert [len(t) for t in diagram.levels] == [1] * 5 and diagram.root.weight == (32,)


def test_audit_matches_plain_orders(spark):
    docs, labels = load(spark, SF, "documents"), load(spark, SF, "labels")
    want = plain_audit([(r.doc_id, r.text, r.source) for r in docs.collect()],
                       [(r.doc_id, r.quality, r.toxic) for r in labels.collect()])
    assert audited(docs, labels) == want


def test_audit_of_awkward_rows(spark):
    long = " ".join(f"w{i % 700}" for i in range(60_000))
    rows = [(1, None, "a"), (2, "", "a"), (3, "", None), (None, "", "a"), (None, "x #", None), (5, long, "b"), (4, long, "b"),
            (4, long, "b"), (4, long, "c"), (6, "ABC $", ""), (6, "ABC $", ""), (7, "É 🙃 A" * 30, "c"), (8, "a\x0bb\x0cc d", "d"),
            *[(100 + i, "one text of a third of all rows", "hot") for i in range(300)]]
    labels = [(1, 1, 0), (1, 0, 1), (4, 1, None), (None, 1, 1), (6, None, 1), (150, 1, 1), (999, 1, 1)]
    docs = spark.createDataFrame([(i, t, "en", s, 0) for i, t, s in rows], DOCS).withColumns(
        {n: F.lit("mine") for n in ("part", "mask", "n", "key", "good", "toxic", "first")})
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int").withColumn("text", F.lit("x"))
    assert audited(docs, marks) == plain_audit(rows, labels)


def test_audit_of_nothing(spark):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert audited(spark.createDataFrame([], DOCS), none) == []
    assert len(audited(spark.createDataFrame([(1, "x", "en", None, 1)], DOCS), none)) == 600


def test_audit_takes_other_filters_and_measures(spark):
    cells = spark.createDataFrame([(None, 0, 5, 2.0), ("p", 3, 4, 1.0)], "part string, mask int, n long, w double")
    got = filter_audit.audit(cells.withColumn("w", F.col("w").cast("long")), "XY", ["w"]).collect()
    assert {(r.part, r.filter_order) for r in got} == {(p, o) for p in (None, "p") for o in ("XY", "YX")}
    assert {(r.step, r.kept, r.removed, r.redundant, r.w_lost, r.shapley) for r in got if r.part == "p"} == {(1, 0, 4, 0, 1, 4), (2, 0, 0, 4, 0, 4)}


# --- 12: vector codes ---------------------------------------------------------------------------

def plain_codes(rows, parts, entries, rounds, scale=1024):
    """``(id, code, error)`` of ``(id, vector)`` rows and the codebooks, every part against every entry."""
    rows = [(i, v) for i, v in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    width = -(-max((len(v) for _, v in rows), default=0) // parts) * parts
    ints = [(i, [math.floor(scale * x) for x in v] + [0] * (width - len(v))) for i, v in rows]
    first = sorted(zip(rows, ints), key=lambda r: (r[0][0] is None, r[0][0] or 0, r[0][1]))[:entries]
    w = width // parts
    out = [[i, "", 0] for i, _ in ints]
    books = []
    for p in range(parts):
        book = [list(x[p * w:(p + 1) * w]) for _, (_, x) in first]
        own = [x[p * w:(p + 1) * w] for _, x in ints]
        for r in range(rounds + 1):
            which = [min(range(len(book)), key=lambda e: (sum((a - b) ** 2 for a, b in zip(x, book[e])), e)) for x in own]
            if r == rounds:
                break
            for e in range(len(book)):
                met = [x for x, k in zip(own, which) if k == e]
                if met:
                    book[e] = [sum(c) // len(met) for c in zip(*met)]
        for o, x, e in zip(out, own, which):
            o[1] += f"{e:02x}"
            o[2] += sum((a - b) ** 2 for a, b in zip(x, book[e]))
        books.append(book)
    return [tuple(o) for o in out], books


def vectors_of(spark, rows):
    return spark.createDataFrame([(i, v, j % 3 if j % 7 else None) for j, (i, v) in enumerate(rows)], "vec_id long, embedding array<double>, label int")


def check_codes(spark, rows, parts=2, entries=8, rounds=3):
    found = vector_codes.compress(vectors_of(spark, rows), ["vec_id", "label"], parts, entries, rounds)
    want, books = plain_codes(rows, parts, entries, rounds)
    assert sorted(map(str, want)) == sorted(str(tuple(r)) for r in found.rows.select("vec_id", "code", "error").collect())
    assert [b.tolist() for b in found.codebooks] == books
    said = ",".join(str(x) for b in books for e in b for x in e)
    assert found.digest() == hashlib.sha256(said.encode()).hexdigest()
    return found


def test_codes_match_plain_lloyd(spark):
    r = random.Random(2)
    check_codes(spark, [(i, [r.gauss(0, 1) for _ in range(8)]) for i in range(400)], 4, 16, 4)
    check_codes(spark, [(i, [r.choice([0.0, 0.001, -0.0005, 1.0]) for _ in range(4)]) for i in range(300)], 2, 16, 3)  # ties


def test_dual_tree_finds_the_nearest_of_all():
    r = np.random.default_rng(4)
    for points in (r.integers(-500, 500, (3000, 16)), np.repeat(r.integers(-9, 9, (40, 3)), 70, axis=0), r.integers(0, 2, (500, 2)),
                   r.integers(-5, 5, (1000, 6)) + 100 * r.integers(0, 9, (1000, 1)), np.zeros((200, 4), np.int64)):
        book = vector_codes.Codebook(points[r.permutation(len(points))[:100]])
        order = vector_codes.tree_order(points, vector_codes.LEAF)
        tree = vector_codes.Tree(points[order], vector_codes.LEAF)
        which, whole = vector_codes.nearest(tree, book)
        distance = ((points[order][:, None, :] - book.entries[None]) ** 2).sum(axis=2)
        assert (which == distance.argmin(axis=1)).all()
        total, count = vector_codes.entry_sums(tree, book)
        assert (count == np.bincount(which, minlength=100)).all()
        assert all((total[e] == points[order][which == e].sum(axis=0)).all() for e in range(100))
    assert whole  # equal points are assigned by a node's sum


def test_codes_prune_clustered_parts():
    r = np.random.default_rng(4)
    points = np.repeat(r.integers(-9000, 9000, (32, 8)), 128, axis=0) + r.integers(-20, 20, (4096, 8))
    order = vector_codes.tree_order(points, vector_codes.LEAF)
    _, whole = vector_codes.nearest(vector_codes.Tree(points[order], vector_codes.LEAF), vector_codes.Codebook(points[::128]))
    edges = {level: vector_codes.bounds(4096, level) for level, _, _ in whole}
    assert sum(edges[level][n + 1] - edges[level][n] for level, n, _ in whole) > 2048


def test_codes_of_awkward_rows(spark):
    rows = [(5, None), (6, [1.0, None]), (7, [float("nan"), 1.0]), (8, [float("inf"), 0.0]), (3, [0.5, -0.5, 0.25]), (3, [0.5, -0.5, 0.25]),
            (None, [0.1, 0.2, 0.3, 0.4, 0.5]), (1, []), (2, [-0.0001]), (9, [0.3, 0.3]), (3, [0.1])] + [(50 + i, [0.25, 0.75]) for i in range(60)]
    check_codes(spark, rows, 2, 4, 2)
    check_codes(spark, [(1, []), (2, [])], 2, 4, 2)
    check_codes(spark, [(1, [300.0, -9000.5])], 2, 4, 2)  # beyond 16-bit integers
    big = vector_codes.compress(vectors_of(spark, [(1, [1e300, 0.0]), (2, [0.0, 0.0])]), ["vec_id"], 2, 2, 1)
    assert sorted(r.error for r in big.rows.collect()) == [0, 0]


def test_codes_of_nothing_and_clashing_columns(spark):
    empty = vector_codes.compress(vectors_of(spark, [(1, None)]), ["vec_id", "label"])
    assert empty.rows.count() == 0 and vector_codes.with_label_error(empty).count() == 0
    rows = vectors_of(spark, [(1, [0.5, 0.5]), (2, [0.1, 0.9])]).withColumns({n: F.lit("mine") for n in ("code", "error", "vector", "points", "x")})
    found = vector_codes.compress(rows, ["vec_id", "label", "code", "x"], 2, 2, 1).rows
    assert found.columns == ["vec_id", "label", "x", "code", "error"] and {r.x for r in found.collect()} == {"mine"}


def test_codes_query_sums_errors_by_label(spark):
    got = queries.op12_codes(spark, SF).collect()
    rows = load(spark, SF, "embeddings").collect()
    label, error = {r.vec_id: r.label for r in rows}, {r.vec_id: r.error for r in got}
    by = Counter()
    for i, e in error.items():
        by[label[i]] += e
    assert len(got) == len(rows) and all(r.label_error == by[label[r.vec_id]] for r in got)


# --- 13: multi-index -----------------------------------------------------------------------------

def plain_neighbours(rows, q, k):
    """Positions of the ``k`` rows best for row ``q``, itself left out."""
    scored = [(-sum(x * y for x, y in zip(rows[q][1], v)), i is None, i or 0, p) for p, (i, v) in enumerate(rows) if p != q]
    return [(rows[p][0], -s) for s, _, _, p in sorted(scored)[:k]]


def found_for(spark, rows, every, k=20, **kw):
    index = multi_index.build(spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumns(
        {n: F.lit("mine") for n in ("i", "j", "row", "v")}), k=k, **kw)
    return multi_index.search(index, index.table.where(F.col("vec_id") % every == 0), k).collect()


@pytest.mark.parametrize("sf", ["0.001", "0.01"])
def test_neighbours_reach_their_recall(spark, sf):
    d = f"/root/testdata/sf{sf}"
    got = {}
    for r in queries.op13_neighbours(spark, d).collect():
        got.setdefault(r.query_id, []).append(r)
    rows = {r.vec_id: np.array(r.embedding, np.float64) for r in load(spark, d, "embeddings").collect()}
    hits = 0
    for q, found in got.items():
        found.sort(key=lambda r: r.rank)
        scores = {i: float((rows[q] * v).sum()) for i, v in rows.items() if i != q}
        assert [r.rank for r in found] == list(range(1, 21))
        assert all(abs(scores[r.vec_id] - r.score) < 1e-12 for r in found)
        assert [(-r.score, r.vec_id) for r in found] == sorted((-r.score, r.vec_id) for r in found)
        hits += len({r.vec_id for r in found} & set(sorted(scores, key=lambda i: (-scores[i], i))[:20]))
    assert set(got) == {i for i in rows if i % 20 == 0} and hits >= 0.9 * 20 * len(got)


def test_neighbours_of_few_rows_are_all_of_them(spark):
    rows = [(0, [1.0, 0.0]), (2, [1.0, 1.0]), (1, [1.0, 1.0]), (None, [3.0, -1.0]), (4, [-1.0, 0.5, 2.0]), (5, None), (6, [0.0, 0.0]),
            (7, [float("nan"), 1.0]), (8, []), (9, [None, 1.0]), (0, [1.0, 0.0]), (10, [float("inf"), 1.0])]
    got = found_for(spark, rows, 20)
    sound = [(i, (v + [0.0] * 3)[:3]) for i, v in rows if i in (0, 1, 2, 4, None)]
    want = sorted((0, n + 1, i, s) for q in (0, len(sound) - 1) for n, (i, s) in enumerate(plain_neighbours(sound, q, 20)))
    assert sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in got if r.vec_id is not None) == [w for w in want if w[2] is not None]
    assert sorted(r["rank"] for r in got if r.vec_id is None) == [w[1] for w in want if w[2] is None]


def test_neighbours_in_a_cell_that_holds_most_rows(spark):
    r = random.Random(9)
    rows = [(i, [0.6, 0.8, 0.0, 0.0]) for i in range(4000)] + [(4000 + i, [r.gauss(0, 1) for _ in range(4)]) for i in range(400)]
    got = {}
    for x in found_for(spark, rows, 400, k=5):
        got.setdefault(x.query_id, []).append((x["rank"], x.vec_id, x.score))
    hits = sum(len({v for _, v, _ in got[q]} & {i for i, _ in plain_neighbours(rows, q, 5)}) for q in got)
    assert set(got) == set(range(0, 4400, 400)) and hits >= 0.9 * 5 * len(got)


def test_index_of_nothing(spark):
    rows = spark.createDataFrame([(0, None), (1, [0.0])], "vec_id long, embedding array<double>")
    assert multi_index.build(rows) is None
    one = found_for(spark, [(0, [1.0])], 20)
    assert one == []


def test_traversal_takes_cells_by_their_sum():
    r = np.random.default_rng(3)
    first, second = r.normal(size=7), r.normal(size=5)
    counts = r.integers(0, 4, (7, 5))
    order, taken = multi_index.visit(first, second, counts.tolist(), 20)
    columns = np.argsort(-second, kind="stable")
    visited = {(int(i), int(j)) for i, t in zip(order, taken) for j in columns[:t]}
    sums = sorted(((first[i] + second[j], i, j) for i in range(7) for j in range(5)), reverse=True)
    got, want = 0, set()
    for _, i, j in sums:
        if got >= 20:
            break
        got += counts[i, j]
        want.add((i, j))
    assert visited == want
