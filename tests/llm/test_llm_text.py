from __future__ import annotations

import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from wearline.llm import html_text, packing, piece_codec

CODEC = public_tokenizers.path(piece_codec.VOCABULARY)


@pytest.fixture(scope="module")
def library():
    import sentencepiece
    return sentencepiece.SentencePieceProcessor(model_file=CODEC)


@pytest.fixture(scope="module")
def vocabulary():
    return piece_codec.Vocabulary(CODEC)


def test_packing_odd_rows(documents, odd_rows, small_batches):
    check_packing(packing.pack(documents(odd_rows)).collect(), odd_rows)


def test_packing_table(spark, sf):
    docs = spark.read.parquet(f"{sf['0.01']}/documents.parquet")
    rows = packing.pack(docs).collect()
    check_packing(rows, [(r.doc_id, r.text) for r in docs.collect()])
    tokens = sum(r.length for r in rows)
    assert len({r.sequence_id for r in rows}) <= 1.01 * -(-tokens // packing.CAPACITY) + 1


def check_packing(got, rows):
    encode = Tokenizer.from_file(public_tokenizers.path(packing.VOCABULARY)).encode
    want = Counter()
    for d, t in rows:
        ids = [*encode(t or "", add_special_tokens=False).ids, 2]
        first = (len(ids) - 1) % 1024 + 1
        for i, a in enumerate([0, *range(first, len(ids), 1024)]):
            part = ids[a:first if i == 0 else a + 1024]
            want[d, i, a, len(part), zlib.crc32(np.array(part, dtype="<u4").tobytes())] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
    sequences = {}
    for r in got:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in sequences.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= 1024


def test_packing_empty_table(documents):
    assert packing.pack(documents([])).collect() == []


def test_pieces_with_ids(documents):
    got = packing.pieces(documents([(1, "a b"), (2, None)]), with_ids=True).collect()
    assert {r.doc_id: r.ids for r in got} == {1: [64, 275, 2], 2: [2]}


@settings(max_examples=25, deadline=None)
@given(st.dictionaries(st.integers(1, 32), st.integers(1, 400), max_size=20))
def test_plan_places_every_piece_once(lengths):
    counts = np.zeros(33, dtype=np.int64)
    for k, n in lengths.items():
        counts[k] = n
    fillings = packing.plan(counts, 32, rounds=60)
    held = Counter()
    for filling, times in fillings:
        assert sum(k * n for k, n in filling.items()) <= 32 and times > 0
        for k, n in filling.items():
            held[k] += n * times
    assert held == Counter({k: n for k, n in lengths.items()})


def test_knapsack_is_optimal():
    rng = np.random.default_rng(0)
    for _ in range(20):
        price = np.r_[0, rng.random(12)]
        best = np.zeros(13)
        for c in range(1, 13):
            best[c] = max([best[c - 1], *(best[c - k] + price[k] for k in range(1, c + 1))])
        got = packing.best_filling(price, 12)
        assert sum(price[k] * n for k, n in got.items()) == pytest.approx(best[12])


TEXTS = ["", " ", "  a  b \n c", "▁x <s> </s><unk>\x00é𝄞", "aaaa" * 50, "tab\tand\r\nend ", "x", "wordword  again"]


def test_codec_is_the_librarys(library, vocabulary):
    rng = random.Random(2)
    letters = list("abcdeéß ▁\n\t  th梦𝄞\x00")
    texts = TEXTS + ["".join(rng.choice(letters) for _ in range(rng.randrange(60))) for _ in range(400)]
    words = piece_codec.Words(vocabulary)
    for t in texts:
        want = library.encode(t)
        assert piece_codec.encode(vocabulary, t) == want
        assert np.frombuffer(words.ids(t), dtype="<u4").tolist() == want
        assert piece_codec.decode(vocabulary, want) == library.decode(want)


def test_codec_keeps_a_bounded_window(library, vocabulary):
    text = "thequickbrownfox" * 3000
    stream = piece_codec.Stream(vocabulary)
    committed = 0
    for i, ch in enumerate(piece_codec.SPACE + text):
        stream.push(ch)
        committed = max(committed, len(stream.ids))
    assert committed > 1000  # long before the end
    stream.close()
    assert stream.widest <= 3 * vocabulary.longest and stream.ids == library.encode(text)


def test_codec_frames(documents, odd_rows, library, small_batches):
    docs = documents(odd_rows)
    rows = piece_codec.encoded(docs)
    want = sorted((repr((d, library.encode(t or ""))) for d, t in odd_rows))
    assert sorted(repr((r.doc_id, list(r.ids))) for r in rows.collect()) == want
    back = piece_codec.decoded(rows).collect()
    spaced = [(d, (t or "").replace("▁", " ")) for d, t in odd_rows]
    assert sorted(map(repr, ((r.doc_id, r.text) for r in back))) == sorted(map(repr, spaced))
    for r in piece_codec.digest(docs).collect():
        t = next(t for d, t in odd_rows if d == r.doc_id) or ""
        ids = library.encode(t)
        assert (r.n_ids, r.ids_crc32) == (len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes()))
        assert r.round_trip == ("▁" not in t)
    assert piece_codec.digest(documents([])).collect() == []


def test_codec_table(spark, sf, library):
    docs = spark.read.parquet(f"{sf['0.001']}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    for r in piece_codec.digest(docs).collect():
        ids = library.encode(texts[r.doc_id])
        assert (r.n_ids, r.ids_crc32, r.round_trip) == (len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes()), True)


PAGE = """<html><head><title>T</title><style>p{}</style></head><body><header class="site-header"><p>The best site.</p>
</header><nav><a href=x>Home</a></nav><div class="cookie-notice">We use cookies. Accept them all?</div><main><article>
<header><h1>Title &amp; more</h1></header><p>Caf&eacute; &#8212; one <a href="x>y">link</a> here.<p>Two&nbsp;words
<ul><li>a<li>b</ul><form><label>Name</label><input></form><script>var t = "</p>";</script><pre>x
 y</pre><table><tr><td>1<td>2</table><aside>See also this.</aside><div class="comments"><p>Nice post, thanks a lot.</p></div>
</article></main><div class=sidebar><p>Long text in the sidebar that goes on and on.</p></div><footer>&copy; us</footer></body>"""


def test_html_page():
    assert html_text.main_text(PAGE) == "Title & more\nCafé — one link here.\nTwo words\na\nb\nx y\n1\n2"


@pytest.mark.parametrize("source", ["", "<", "<p", "<!-- never closed", "<p>a<p>b</div></p>", "<a href='x>" * 50,
                                    "<div>" * 3000, "&#xFFFFFFFF; &bad; &amp", "<script>never closed", "\x00<b>\x00"])
def test_html_broken_pages(source):
    assert isinstance(html_text.main_text(source), str)


def test_html_tree_learns_its_table():
    tree = html_text.grow(np.array(html_text.TRAINING, dtype=float))
    assert all(html_text.decide(tree, list(r[:-1])) == r[-1] for r in html_text.TRAINING)


def test_html_frames(spark, small_batches):
    long_ = "<article>" + "".join(f"<p>Paragraph {i} has words.</p>" for i in range(5000)) + "</article>"
    rows = [(1, "u", PAGE, "x"), (1, "u", PAGE, "x"), (2, None, None, "y"), (None, "v", "", "z"), (3, "w", long_, None)]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = html_text.extracted(frame).collect()
    assert sorted((str(r.page_id), str(r.url), r.n_chars) for r in got) == sorted(
        (str(i), str(u), len(html_text.main_text(h or ""))) for i, u, h, _ in rows)
    assert next(r.text for r in got if r.page_id == 3).count("\n") == 4999
    assert html_text.extracted(frame.limit(0)).collect() == []


def test_html_table(spark, sf):
    import html
    import re
    pages = spark.read.parquet(f"{sf['0.01']}/pages.parquet")
    got = {r.page_id: r.text for r in html_text.extracted(pages).collect()}
    for r in pages.collect():
        inner = re.search(r"<article>(.*?)</article>", r.html, re.S)[1]
        parts = re.sub(r"<(/?(?:h1|p)|br)\b[^>]*>", "\0", re.sub(r"\s+", " ", inner))
        plain = [" ".join(html.unescape(re.sub(r"<[^>]+>", "", x)).split()) for x in parts.split("\0")]
        assert " ".join(got[r.page_id].split()) == " ".join(x for x in plain if x)
