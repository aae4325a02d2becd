"""Vector codes, Merkle manifests and page texts against brute force and hand-made cases."""

import hashlib
import itertools
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from closepass.llm import merkle, page_text, vector_codes

# --- vector codes ---

VECTORS = "vec_id long, label int, embedding array<float>, code string, near int"


def plain_codes(vectors, rounds):
    """vectors: integer lists in codebook order; (codes, errors, books) by plain loops."""
    width = len(vectors[0]) // vector_codes.PARTS
    cut = [[v[p * width : (p + 1) * width] for p in range(vector_codes.PARTS)] for v in vectors]
    books = [[cut[e][p] for e in range(min(vector_codes.ENTRIES, len(cut)))] for p in range(vector_codes.PARTS)]

    def assign():
        return [
            [min((sum((a - b) ** 2 for a, b in zip(x, c)), e) for e, c in enumerate(books[p])) for p, x in enumerate(parts)]
            for parts in cut
        ]

    for _ in range(rounds):
        near = assign()
        for p in range(vector_codes.PARTS):
            for e in range(len(books[p])):
                own = [cut[i][p] for i in range(len(cut)) if near[i][p][1] == e]
                if own:
                    books[p][e] = [sum(x) // len(own) for x in zip(*own)]
    near = assign()
    return [[e for _, e in n] for n in near], [sum(d for d, _ in n) for n in near], books


@pytest.mark.parametrize("rounds,scale,n", [(2, 0.2, 300), (6, 3.0, 300), (2, 0.02, 200), (2, 1.0, 20)])
def test_codes_match_plain_loops(spark, rounds, scale, n):
    random = np.random.default_rng(rounds * n)
    centres = random.normal(0, scale, (5, 32))
    values = (centres[random.integers(0, 5, n)] + random.normal(0, scale / 4, (n, 32))).astype(np.float32)
    values[7] = values[3]  # copies
    ids = random.permutation(n).tolist()
    rows = [(i, i % 3 or None, v.tolist(), "x", 1) for i, v in zip(ids, values)]
    rows += [(1000, 1, None, "x", 1), (1001, 1, [float("nan")] * 32, "x", 1), (1002, 1, [None] * 32, "x", 1), (-5, 1, [float("inf")] * 32, "x", 1)]
    rows += [(1003, 1, [], "x", 1), (1004, 1, [1.0] * 16, "x", 1)]
    frame = spark.createDataFrame(rows, VECTORS).select("vec_id", "label", "embedding").repartition(3)
    got, book = vector_codes.compressed(frame, "vec_id", "embedding", rounds)
    got = {r.vec_id: (list(r.code), r.error) for r in got.collect()}
    order = np.argsort(ids)
    whole = np.floor(values.astype(np.float64) * 256).astype(int)[order].tolist()
    codes, errors, books = plain_codes(whole, rounds)
    assert got == {k: (codes[k], errors[k]) for k in range(n)}
    assert book.tolist() == books


def test_bounds_spare_comparisons_and_lists_shrink():
    random = np.random.default_rng(5)
    parts = np.floor(random.normal(0, 100, (500, vector_codes.PARTS, 4)))
    book = parts[:64].transpose(1, 0, 2)
    near, squared, low, outer, b = vector_codes.Assigner(book).first(parts)
    assert b == 16 and (np.diff(low, axis=2) >= 0).all() and (outer >= low[:, :, -1]).all()
    new = book + random.integers(-1, 2, book.shape)
    found = vector_codes.Assigner(new, book).again(parts, near, vector_codes.lowered(low).astype(float), vector_codes.lowered(outer).astype(float))
    exact = vector_codes.nearest(parts, new).transpose(1, 0, 2)
    assert (found[0][:, :, 0] == exact.argmin(axis=2)).all() and (found[1] == exact.min(axis=2)).all()
    assert found[4] == 8 and found[0].shape[2] == 8
    true = np.sqrt(np.take_along_axis(exact, found[0], axis=2))
    assert (found[2] <= true + 1e-6).all()
    others = np.ones(exact.shape, dtype=bool)
    np.put_along_axis(others, found[0], False, axis=2)
    assert (found[3] <= np.sqrt(np.where(others, exact, np.inf).min(axis=2)) + 1e-6).all()


def test_codes_of_odd_tables(spark):
    empty = spark.createDataFrame([], "vec_id long, label int, embedding array<float>")
    rows, book = vector_codes.compressed(empty, "vec_id", "embedding")
    assert rows.collect() == [] and rows.columns == ["vec_id", "label", "code", "error"] and book.size == 0
    odd = spark.createDataFrame([(None, None, [0.5] * 20), (3, None, [0.25] * 20), (3, 1, [-0.25] * 20)], empty.schema)
    rows, book = vector_codes.compressed(odd, "vec_id", "embedding")  # 20 components: filled up to 32
    assert sorted((list(r.code)[0], r.error) for r in rows.collect()) == [(0, 0), (1, 0), (2, 0)]
    assert book[0].tolist() == [[-64, -64], [64, 64], [128, 128]] and book[15].tolist() == [[0, 0]] * 3
    with pytest.raises(Exception, match="too large"):
        vector_codes.compressed(spark.createDataFrame([(1, 1, [1e30] * 16)], empty.schema), "vec_id", "embedding")


# --- Merkle manifests ---


def h(*texts):
    return hashlib.sha256("".join(texts).encode()).hexdigest()


def plain_tree(leaves):
    """(root, siblings of each leaf to the left and right by level)."""
    steps, level, owner = [[] for _ in leaves], list(leaves), [[i] for i in range(len(leaves))]
    while len(level) > 1:
        runs = [range(k, min(k + 8, len(level))) for k in range(0, len(level), 8)]
        for run in runs:
            for j in run:
                for leaf in owner[j]:
                    steps[leaf].append(("".join(level[i] for i in run if i < j), "".join(level[i] for i in run if i > j)))
        level = [h(*(level[i] for i in run)) for run in runs]
        owner = [[leaf for j in run for leaf in owner[j]] for run in runs]
    return level[0], steps


def plain_manifest(rows):
    """rows: (doc_id, lang, leaf) -> rows of (doc_id, leaf, subroot, root, siblings)."""
    trees = {}
    for row in sorted(rows, key=lambda r: (r[1] is not None, (r[1] or "").encode(), r[0] is not None, r[0] or 0, r[2])):
        trees.setdefault(row[1], []).append(row)
    grown = [plain_tree([r[2] for r in own]) for own in trees.values()]
    root, above = plain_tree([g[0] for g in grown])
    return sorted(
        (str(r[0]), r[2], sub, root, steps[i] + above[k])
        for k, (own, (sub, steps)) in enumerate(zip(trees.values(), grown))
        for i, r in enumerate(own)
    )


@pytest.mark.parametrize("sizes", [[1], [8], [9], [1, 1, 1], [600, 65, 64, 1, 8], [3] * 20])
def test_manifest_matches_plain_trees(spark, sizes):
    langs = [None, "b", "a", "é", "B", *(f"x{i}" for i in range(20))]
    rows = [(i * 7 % 1000, lang, h(str(i), str(lang))) for n, lang in zip(sizes, langs) for i in range(n)]
    rows += [rows[0], (None, rows[0][1], h("none"))] if len(sizes) > 3 else []
    frame = spark.createDataFrame(rows, "doc_id long, lang string, leaf string").repartition(5)
    got = merkle.manifest(frame, "lang", "doc_id")
    proof = merkle.proof_hash(F.col("path")).alias("proof")
    got = got.select("*", proof, merkle.folded(F.col("leaf"), F.col("path")).alias("again"), merkle.folded(F.lit("x"), F.col("path")).alias("other")).collect()
    assert sorted((str(r.doc_id), r.leaf, r.subroot, r.root, [tuple(s) for s in r.path]) for r in got) == plain_manifest(rows)
    assert all(r.again == r.root and r.proof == h(*(a + b for a, b in r.path)) for r in got)
    assert len(rows) == 1 or all(r.other != r.root for r in got)


def test_leaves_of_odd_rows(spark, tmp_path):
    schema = "doc_id long, text string, lang string, source string, n_chars long, tree int, place string, hash string"
    rows = [(0, "ÄB", "en", "s", 2, 1, "p", "h"), (None, None, None, None, None, 1, "p", "h"), (2, "", "en", "", 0, 1, "p", "h"), (2, "", "en", "", 0, 1, "p", "h")]
    rows.append((3, "Aé" * 500_000, "en", "s", 1, 1, "p", "h"))
    spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.leaf: r for r in merkle.op12_slot_pivot_merkle(spark, str(tmp_path)).collect()}
    none, empty = h("-----"), h("1:2", "0:", "2:en", "1:0", "0:")
    first, long = h("1:0", "1:s", "2:en", "1:2", "3:ÄB"), h("1:3", "1:s", "2:en", "1:1", "1500000:" + "Aé" * 500_000)
    assert set(got) == {none, empty, first, long}
    assert got[none].verified and got[empty].verified == (zlib.crc32(b"2") % 3 != 0 or True)
    assert got[first].verified == (zlib.crc32(b"0") % 3 != 0) and got[long].verified == (zlib.crc32(b"3") % 3 != 0)
    spark.createDataFrame([], schema).write.parquet(f"{tmp_path}/none/documents.parquet")
    assert merkle.op12_slot_pivot_merkle(spark, f"{tmp_path}/none").collect() == []


# --- page texts ---

PRIOR_ONLY = page_text.weights(np.zeros((page_text.CELLS, 2)))
LONG = "This is a sentence of the article, which goes on for some more words, as such sentences do. " * 2


def text_of(page):
    return page_text.main_blocks(page, PRIOR_ONLY)


def test_cut_is_least(spark):
    random = np.random.default_rng(4)
    for _ in range(60):
        n = int(random.integers(1, 8))
        net = random.integers(-9, 10, n).tolist()
        edges = [(a, b, int(random.integers(1, 7))) for a, b in itertools.combinations(range(n), 2) if random.random() < 0.5]

        def cost(kept):
            own = sum(c for c, k in zip(net, kept) if c > 0 and not k) - sum(c for c, k in zip(net, kept) if c < 0 and k)
            return own + sum(c for a, b, c in edges if kept[a] != kept[b])

        least = min(cost(kept) for kept in itertools.product([False, True], repeat=n))
        assert cost(page_text.source_side(net, edges)) == least


def test_articles_without_what_stands_around_them():
    page = f"""<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style></head><body class="has-sidebar">
    <header class="site-header"><a href="/">Site</a></header><nav><ul><li><a href=x>One</a></li></ul></nav>
    <div class="cookie-notice" role="alertdialog"><p>{LONG}</p><button>OK</button></div>
    <main><article class="post"><header><h1>A &amp; B</h1></header><p>{LONG}</p><h2>Short</h2><ul><li>item</li></ul>
    <script>var x = "</p><p>no";</script><aside><p>{LONG}</p></aside><!-- <p>no</p> -->
    <p>One&nbsp;<b>bold</b>
      line <a href=x>link</a>&lt;</p><table><tr><td>cell<td>other</table><div class="ad-slot">{LONG}</div><p>Last.</p></article>
    <section id="comments"><article class="comment"><p>{LONG}</p></article></section></main>
    <div class="sidebar widget"><p>{LONG}</p></div><form><label>Name</label><input><textarea>no</textarea></form>
    <footer>&copy; all</footer></body></html>"""
    assert text_of(page) == ["A & B", LONG.strip(), "Short", "item", "One bold line link<", "cell", "other", "Last."]


def test_pages_without_such_elements():
    menu = "<div>" + "".join(f'<a href="{k}">Item {k}</a> ' for k in range(9)) + "</div>"
    page = f"<html><body>{menu}<div><h1>Heading of it all</h1><p>{LONG}</p><p>Short one.</p><p>{LONG}</p></div>{menu}<div>Copyright us</div>"
    assert text_of(page) == ["Heading of it all", LONG.strip(), "Short one.", LONG.strip()]


def test_broken_pages():
    assert text_of(None) == text_of("") == text_of("<p> <br>") == text_of("<script>x") == text_of("<!-- x") == []
    assert text_of(f"<article><p><b>Bold<br><p>{LONG}</p><foot") == ["Bold", LONG.strip()]
    assert text_of("<article><p>1 < 2 &unknown; &am &#x41;&amp;lt;</article>") == ["1 < 2 &unknown; &am A&lt;"]
    assert text_of(f"<article><p title='a>b\" c'>{LONG}</p></div></article>") == [LONG.strip()]
    assert text_of("<article>" + "<div>" * 3000 + LONG) == [LONG.strip()]
    many = text_of("<article>" + f"<p>{LONG}</p>" * 20_000)
    assert len(many) == 20_000


def test_extraction_of_tables(spark):
    schema = "page_id long, url string, html string, text string, n_chars long, cell int"
    page = f"<nav><a>x</a></nav><article><h1>H</h1><p>{LONG}</p></article>"
    rows = [(1, "u", page, "t", 1, 2), (1, "u", page, "t", 1, 2), (None, None, None, None, None, None), (2, "u", "", "", 0, 0)]
    pages = spark.createDataFrame(rows, schema)
    got = page_text.extracted(pages, page_text.fit(pages)).orderBy("page_id").collect()
    assert [r.text for r in got] == ["", f"H\n{LONG.strip()}", f"H\n{LONG.strip()}", ""] and got[1].cell == 2
    none = pages.where("false")
    assert page_text.extracted(none, page_text.fit(none)).collect() == []
