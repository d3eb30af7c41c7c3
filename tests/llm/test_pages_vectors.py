"""Block labelling of pages, nearest neighbours, and the pipeline."""

import time

import numpy as np
import pytest
from cases import collected, none, odd_documents, odd_rows, with_clashes, words

import corpus_pipeline
from cohortlens.llm import blocks, mixing, neardup, pii, toxicity, vectors


def page(i, body):
    nav = "".join(f"<li><a href=/{k}>{w}</a></li>" for k, w in enumerate(words(4, i).split()))
    return (
        f"<!DOCTYPE html><html><head><title>{words(3, i)}</title><script>var a='<p>no</p>'</script></head><body><nav><ul>{nav}</ul></nav>"
        f"<div class='ad'>{words(6, i + 1)}</div><article><h1>{words(4, i + 2)}</h1>{body}</article><footer>&copy; {words(3, i)}</footer></body></html>"
    )


def pages(spark, n=120):
    rows, want = [], {}
    for i in range(n):
        parts = [words(5 + (i * 7 + k) % 30, 1000 + 10 * i + k) for k in range(2 + i % 4)]
        rows.append((i, f"http://x/{i}", page(i, "".join(f"<p>{p}  &amp; <b>more</b>\n text" for p in parts))))
        want[i] = "\n".join([words(4, i + 2), *(f"{p} & more text" for p in parts)])
    return spark.createDataFrame(rows, "page_id long, url string, html string"), want


def test_articles_are_extracted(spark):
    df, want = pages(spark)
    found = {r["page_id"]: r for r in blocks.extract(df).collect()}
    right = sum(found[i]["text"] == want[i] for i in want)
    assert right >= 0.97 * len(want)
    assert all(r["n_chars"] == len(r["text"]) for r in found.values())


def test_odd_pages(spark):
    rows = [
        (1, "u", None), (2, None, ""), (None, "u", "<p>lonely"), (3, "u", "plain words only"), (4, "u", "<a<b>>&#x41;&#65;&eacute;"),
        (5, "u", "<article>" + "<p>word</p>" * 6000 + "</article>"), (6, "u", "<!-- never closed"), (7, "u", "<script>x"),
        (8, "u", "<article><p>same</p></article>"), (8, "u", "<article><p>same</p></article>"),
    ]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    plain = collected(blocks.extract(df))
    assert len(plain) == len(rows)
    assert collected(blocks.extract(with_clashes(df))) == plain
    assert blocks.extract(df.limit(0)).collect() == []


def test_blocks_of_markup():
    got = [(p[-1:], t) for p, t, _ in blocks.cut("<div>a<p class=x>b<br>c<b>d</b><li>e<li>f &lt; g</div>h<script>no</script>")]
    assert got == [(("div",), "a"), (("p.x",), "b cd"), (("li",), "e"), (("li",), "f < g"), ((), "h")]


def test_drawings_formulas_and_custom_elements_do_not_cut_a_page():
    for body, want in [
        ('<p>one</p><svg class="i"/><p>two</p><p>three</p>', ["one", "two", "three"]),
        ('<p>one</p><SVG aria-label="a > b" /><p>two</p>', ["one", "two"]),
        ('<p>one</p><svg class="i"><g/><text>no</text></svg><p>two</p>', ["one", "two"]),
        ("<p>one</p><object-card>in</object-card><p>two</p>", ["one", "in", "two"]),
        ("<p>one</p><object data=x>no</object><p>two</p>", ["one", "two"]),
        ("<p>E = <math><mi>m</mi><mspace/><msup><mi>c</mi><mn>2</mn></msup></math> holds</p>", ["E = mc2 holds"]),
        ("<p>one</p><math/><p>two</p>", ["one", "two"]),
    ]:
        assert [t for _, t, _ in blocks.cut(f"<article>{body}</article>")] == want


def test_text_behind_an_element_without_an_end_tag_is_read():
    for page, want in [
        ("<p>one</p><object data=x><p>two</p>", ["one", "two"]),
        ("<p>one</p><canvas id=c><p>two</p>", ["one", "two"]),
        ("<p>one</p><noscript><p>two</p>", ["one", "two"]),
        ("<p>one</p><iframe src=x><p>two</p>", ["one", "two"]),
        ("<object>one<object>no</object>", ["one"]),
        # Empty comments and comments that end in a mark.
        ("<p>a</p><!--><p>b</p><!---><p>c</p><!-- no --!><p>d</p><!-- no --><p>e", ["a", "b", "c", "d", "e"]),
        # Elements inside their like.
        ("<p>a</p><svg><svg>no</svg>no</svg><p>b</p>", ["a", "b"]),
        ("<p>a</p><template><div><template>no</template>no</div></template>b", ["a", "b"]),
        # Tags inside scripts, and openings of comments inside frames, do not count.
        ('<object><script>"<object>"</script>no</object>a', ["a"]),
        ("<iframe><!-- no</iframe><p>a</p><!-- no -->", ["a"]),
        ("<p>a</p><script>no", ["a"]),
    ]:
        assert [t for _, t, _ in blocks.cut(page)] == want, page


def test_many_open_elements_take_linear_time():
    for page in ("<object>" * 100_000, "<iframe>" * 100_000, "<svg>" * 50_000 + "</svg>" * 50_000):
        begin = time.perf_counter()
        assert blocks.cut(page) == []
        assert time.perf_counter() - begin < 10


def test_lstm_gradients_agree_with_differences():
    rng = np.random.default_rng(2)
    net = blocks.Labeller()
    net.w = {k: v.astype(np.float64) for k, v in net.w.items()}
    x, live = blocks.padded([rng.random((4, blocks.INPUT)), rng.random((2, blocks.INPUT))])
    x = x.astype(np.float64)
    label = (rng.random(live.shape) > 0.5).astype(np.float64)

    def loss():
        z, _ = net.logits(x, live)
        return ((np.logaddexp(0, z) - label * z) * live).sum() / live.sum()

    grad = net.gradients(x, live, label)
    for name in ("hf", "hb", "xf", "o", "bb"):
        flat = net.w[name].reshape(-1)
        i = int(np.abs(grad[name]).argmax())
        old = flat[i]
        flat[i] = old + 1e-4
        up = loss()
        flat[i] = old - 1e-4
        down = loss()
        flat[i] = old
        assert abs((up - down) / 2e-4 - grad[name].reshape(-1)[i]) < 1e-4


def brute(rows, k):
    usable = {i: np.array(v) for i, v in rows if i is not None and v and None not in v and np.isfinite(v).all() and any(v) and len(v) == 8}
    out = {}
    for q in (i for i in usable if i % 20 == 0):
        others = sorted((-float(np.cumsum(usable[q] * usable[i])[-1]), i) for i in usable if i != q)[:k]
        out[q] = [(i, -s) for s, i in others]
    return out


@pytest.mark.parametrize("block", [2000, 7])
def test_neighbours_of_odd_vectors_equal_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(vectors, "BLOCK", block)
    rng = np.random.default_rng(1)
    rows = [(i, [float(np.float32(x)) for x in rng.standard_normal(8) * (1 + i % 3)]) for i in range(100)]
    rows += [(i, rows[40][1]) for i in range(100, 160)]  # copies
    rows += [(200, None), (201, []), (202, [0.0] * 8), (203, [1.0] * 7 + [float("nan")]), (204, [1.0] * 7 + [None]), (205, [1.0] * 3), (None, [1.0] * 8)]
    rows += [rows[60]]  # a repeated row
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    found = {}
    for r in vectors.nearest(with_clashes(df), df.where("vec_id % 20 = 0").select("vec_id"), 5).collect():
        found.setdefault(r["query_id"], {})[r["rank"]] = (r["vec_id"], r["score"])
    want = brute(rows, 5)
    assert {q: [v for _, v in sorted(d.items())] for q, d in found.items()} == want
    assert vectors.nearest(df.limit(0), df.limit(0).select("vec_id")).collect() == []


def test_recall_of_routed_queries(spark, monkeypatch):
    monkeypatch.setattr(vectors, "PART", 64)
    rng = np.random.default_rng(5)
    centres = rng.standard_normal((30, 24))
    x = (centres[rng.integers(0, 30, 3000)] + 0.5 * rng.standard_normal((3000, 24))).astype(np.float32)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>")
    rows = vectors.nearest(df, df.where("vec_id % 20 = 0").select("vec_id")).collect()
    found = {}
    for r in rows:
        found.setdefault(r["query_id"], set()).add(r["vec_id"])
    x = x.astype(float)
    hits = 0
    for q in range(0, 3000, 20):
        s = x @ x[q]
        s[q] = -np.inf
        hits += len(found[q] & set(np.argsort(-s)[:20].tolist()))
    assert hits / (20 * 150) >= 0.9


def test_parts_are_balanced():
    x = np.random.default_rng(3).standard_normal((512, 10)).astype(np.float32)
    part = vectors.partition_graph(vectors._graph(x, 8), 8)
    assert np.bincount(part).tolist() == [64] * 8


def test_stages_take_odd_rows_and_keep_the_columns(spark, tmp_path):
    spark.createDataFrame([(1, 1, 0), (5, 1, 1)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    for docs in (odd_documents(spark), none(spark)):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, str(tmp_path))
            if name != "bpe":
                assert out.columns == docs.columns
            out.count()


def test_pipeline_equals_its_operators_one_by_one(spark, tmp_path):
    rows = [r for r in odd_rows() if r[0] is not None] + [(100 + i, f"{words(20, i)} mail a{i}@example.org now", "en", "s1", 0) for i in range(30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    labels = spark.createDataFrame([(1, 1, 0), (5, 1, 0)], "doc_id long, quality int, toxic int")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    found = collected(corpus_pipeline.run(spark, str(tmp_path)))
    clean = toxicity.clean(docs, labels)
    mixed = mixing.mix(pii.masked(neardup.deduplicated(clean)))
    texts = collected(mixed.select("doc_id", "text"))
    assert not any("@example" in (t or "") for _, t in texts)
    from cohortlens.llm import bpe, queries

    assert found == collected(bpe.encode_digests(mixed, queries.WORD_BPE))
