"""The corpus operators against brute force, on small tables with nulls, empties, repeats and odd columns."""

import hashlib
import re
import time
import unicodedata
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from sketchloom.llm import common, html_extract, language_id, license_scan, line_dedup, mih, minhash, packing, piece_bpe, spotsigs, url_filter

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LONG = "The quick brown fox of the north is over the lazy dog and it was in a box for all to see by day. " * 30
TEXTS = [
    None, "", "\n\n", "A repeated line here\nown words of one\nA REPEATED line here ", "a repeated line here\nmore", LONG, LONG, LONG + "and a few words more",
    "Released under the MIT License.", "x  CC BY y\nAll rights reserved.", "This work is licensed under the GNU General Public License, version 3.",
    "日本語 のテキスト 🙂", "  two  spaces ▁ and\ttab ", "!!!", "it's don't WE'LL ÀÉ 12² a_b x''s <|endoftext|>", "le chat est dans la maison et il dort sur le lit de la dame",
]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, pos string, line int"


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "fr" if t and t.startswith("le") else "en", None if i % 5 == 0 else f"s{i % 2}", len(t or ""), "x", 1) for i, t in enumerate(TEXTS)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def test_line_dedup(docs, empty):
    got = {r.doc_id: r for r in line_dedup.dedup_lines(docs).collect()}
    assert got[3].kept_text == TEXTS[3] and got[4].kept_text == "more" and (got[4].n_lines, got[4].n_dropped) == (2, 1)
    assert got[0].kept_text == "" and got[0].n_lines == 1 and got[2].n_lines == 3 and got[6].kept_text == ""
    assert got[4].pos == "x" and line_dedup.line_dedup_report(empty).count() == 0
    assert line_dedup.line_dedup_stage(docs).columns == docs.columns


def test_line_dedup_keeps_the_callers_columns(spark):
    rows = [(1, "a line that repeats\nown", 77, "k", "t"), (2, "a line that repeats\nmore", 78, "l", "u"), (None, "a line that repeats", 79, "m", "v")]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_lines int, kept_text string, digest string")
    assert line_dedup.dedup_lines(df).columns == ["doc_id", "text", "digest", "kept_text", "n_lines", "n_dropped"]
    got = sorted(map(tuple, line_dedup.line_dedup_stage(df).collect()), key=lambda r: r[2])
    assert got == [rows[0], (2, "more", 78, "l", "u"), rows[2]]


def test_line_dedup_of_a_hot_line_and_a_long_text(spark):
    hot = "a line that very many documents hold"
    long = "\n".join(f"line number {i} of the long text" for i in range(60_000))  # 2 MB
    rows = [(i, f"{hot}\nown {i}\n{hot}") for i in range(3000)] + [(5000, long), (5001, long + "\nan end of its own")] + [(7, "again of document seven")] * 2
    got = {}
    for r in line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect():
        got.setdefault(r.doc_id, []).append((r.kept_text, r.n_lines, r.n_dropped))
    assert got[0] == [(f"{hot}\nown 0\n{hot}", 3, 0)] and all(got[i] == [(f"own {i}", 3, 2)] for i in range(1, 3000) if i != 7)
    assert got[5000] == [(long, 60_000, 0)] and got[5001] == [("an end of its own", 60_001, 60_000)]
    assert sorted(got[7]) == [("again of document seven", 1, 0)] * 2 + [("own 7", 3, 2)]


def test_tables_are_written_to_the_shared_folder(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(common, "shared_dir", lambda spark: str(tmp_path))
    df = common.written(spark.range(10).toDF("x"), "ten")
    assert df.count() == 10 and len(list((tmp_path / "sketchloom").iterdir())) == 1
    common.discard(df)
    assert not list((tmp_path / "sketchloom").iterdir())
    monkeypatch.undo()

    class Cluster:
        class conf:
            get = staticmethod(lambda key, default: default)

        class sparkContext:
            master = "yarn"

            class _jsc:
                class sc:
                    class getCheckpointDir:
                        isDefined = staticmethod(lambda: False)

    with pytest.raises(RuntimeError, match="checkpoint"):
        common.shared_dir(Cluster)


def test_pieces(docs, empty):
    path = public_tokenizers.path("piece_bpe_32k.model")
    lib = sentencepiece.SentencePieceProcessor(model_file=path)
    for r in piece_bpe.encode_documents(docs, path).collect():
        ids = lib.encode(TEXTS[r.doc_id] or "")
        assert r.n_tokens == len(ids) and r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(lib.decode(ids).encode()).hexdigest()
    assert piece_bpe.encode_documents(empty, path).count() == 0
    model = piece_bpe.PieceModel(path)
    for ids in ([5], [260, 195, 131, 29871], lib.encode("aaaa bbbb")):
        assert model.decode(ids) == lib.decode(ids)
    odd = ["aaaaaaaaaaaaaaaaaaaaa", "lowerlowerlower" * 20, "ababababab" * 30]
    assert model.encode_words([piece_bpe.SPACE + w for w in odd]) == [lib.encode(w) for w in odd]
    rng = np.random.default_rng(6)
    mixed = ["".join(rng.choice(list(a), n)) for a in ("ab", "lowerest", "0123", "日本語の東京", "thequickbrown<>;=é🙂") for n in (1, 30, 65, 300, 5000)]
    for long in (0, 64, 10_000):
        assert model.encode_words([piece_bpe.SPACE + w for w in mixed], long) == [lib.encode(w) for w in mixed]


def test_pieces_of_a_very_long_word(spark):
    path = public_tokenizers.path("piece_bpe_32k.model")
    lib, model = sentencepiece.SentencePieceProcessor(model_file=path), piece_bpe.PieceModel(path)
    rng = np.random.default_rng(7)
    began = time.time()
    word = "".join(rng.choice(list("etaoinshrdlu"), 1_000_000))
    ids = model.encode_words([piece_bpe.SPACE + word])[0]
    assert time.time() - began < 60 and lib.decode(ids) == word
    long = " ".join("".join(rng.choice(list("etaoinshrdlu"), n)) for n in rng.integers(1, 12, 200_000))  # 1.4 MB
    got = piece_bpe.encode_documents(spark.createDataFrame([(1, long)], "doc_id long, text string"), path).first()
    want = lib.encode(long)
    assert (got.n_tokens, got.ids_sha256) == (len(want), hashlib.sha256(",".join(map(str, want)).encode()).hexdigest())


def test_packing(docs, empty):
    path = public_tokenizers.path("word_bpe_49k.json")
    lib, got = Tokenizer.from_file(path), packing.pack(docs, path, size=64, window_tokens=128).collect()
    ids = {i: np.array([*lib.encode(t or "", add_special_tokens=False).ids, 1], "<u4") for i, t in enumerate(TEXTS)}
    for i, own in ids.items():
        at = 0
        for r in sorted((r for r in got if r.doc_id == i), key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(own) and r.ids_crc32 == zlib.crc32(own[at : at + r.length].tobytes())
            at += r.length
        assert at == len(own)
    short = 0
    for s in {r.sequence_id for r in got}:
        at = 0
        for r in sorted((r for r in got if r.sequence_id == s), key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at == 64 or at & (at - 1) == 0
        short += at < 64
    assert short <= 6 and packing.pack(empty, path).count() == 0


def test_word_ids_after_letters_that_become_letter_and_mark():
    encoder = packing.WordEncoder(public_tokenizers.path("word_bpe_49k.json"), 1)
    grown = [c for c in map(chr, range(0xA0, 0x110000)) if not 0xD800 <= ord(c) < 0xE000 and len(unicodedata.normalize("NFD", c).lower()) != 1]
    assert "\u0130" in grown and "\u0958" in grown
    texts = ["T.C. \u0130. Melih", "\u0130, a. \u0130"] + [f"a{c}. b{c}, {c}. c {c}_, d{c}" for c in grown if not "\uac00" < c < "\ud7a4"]
    want = [np.array([*x.ids, 1], "<u2").tobytes() for x in encoder.lib.encode_batch_fast(texts, add_special_tokens=False)]
    assert encoder.encode(texts) == want


def test_windows_hold_the_target_proportions(spark):
    rng = np.random.default_rng(4)
    rows = [(i, str(rng.choice(["a", "b", "c"], p=[0.6, 0.3, 0.1])), int(rng.integers(1, 60))) for i in range(6000)]
    lengths = spark.createDataFrame(rows, "row long, source string, n long").repartition(7)
    placed = packing.plan(lengths, 2000, {"a": 0.5, "b": 0.3, "c": 0.2}, 16).join(lengths, "row").collect()
    at = 0
    for r in sorted(placed, key=lambda r: r.start):  # one gapless stream, window after window
        assert r.start == at
        at += r.n
    assert [r.window for r in sorted(placed, key=lambda r: r.start)] == sorted(r.window for r in placed)
    sums = Counter()
    for r in placed:
        sums[r.window, r.source] += r.n
    for source, quantum in (("a", 1000), ("b", 600), ("c", 400)):
        total = sum(n for (_, s), n in sums.items() if s == source)
        for w in range(total // quantum):  # deficits carry over, so no window is off by more than a document
            assert abs(sum(sums[v, source] for v in range(w + 1)) - quantum * (w + 1)) < 60


def test_urls(spark):
    urls = ["http://a.example.net/en/1", "http://example.net/de", "https://X.NET?q", "http://fr.org/fr/", None, "none", "http://b.example.com/de/?x", "http://notnet/en/"]
    pages = spark.createDataFrame([(i, u, "clash") for i, u in enumerate(urls)] + [(0, urls[0], "clash")], "page_id long, url string, rule string")
    got = [tuple(r) for r in url_filter.url_filter_report(pages).orderBy("page_id").collect()]
    assert got[0] == got[1] == (0, "a.example.net", "/en/1", "example.net/en/", "allow")
    assert [x[3] for x in got[2:]] == ["net/", None, "org/fr/", None, None, "example.com/de/", None]
    assert [x[4] for x in got[2:]] == ["block", "allow", "allow", "allow", "allow", "block", "allow"] and got[3][1:3] == ("x.net", "")


def test_language(docs, empty):
    got = {r.doc_id: r for r in language_id.language_report(docs).collect()}
    assert got[0].lang_pred == got[13].lang_pred == "und" and got[5].lang_pred == "en"
    assert all(got[i].held_out == (zlib.crc32(str(i).encode()) % 4 == 2) for i in got) and all(0 <= r.score <= 1 for r in got.values())
    assert language_id.language_report(empty).count() == 0
    kept = {r.doc_id for r in language_id.language_stage(docs).collect()}
    assert kept >= {3, 4, 5, 6, 7, 8} and not kept & {0, 1, 2, 13}


def test_language_stage_rejects_what_no_language_shortens(spark):
    rng = np.random.default_rng(9)
    vocabulary = {"en": "the of and that with from house water bread street night under over window".split(), "fr": "le la les que avec dans maison rue nuit eau pain sous vous fenêtre".split()}
    own = [(i, " ".join(rng.choice(vocabulary[lang], rng.integers(1, 60))), lang) for i, lang in enumerate(["en", "fr"] * 150)]
    other = ["Nel mezzo del cammin di nostra vita mi ritrovai per una selva oscura, ché la diritta via era smarrita. " * 2,
             "De kat zat op de mat en keek naar buiten, waar het al de hele dag regende en niemand op straat liep. " * 2,
             "qwpx zzkj vvqx kjhg wqpo zxcm vbnq plok mijn uhby qzwx kkjv", "Это простой русский текст для проверки того, что он уходит.", "このテキストは日本語で書かれています。"]
    df = spark.createDataFrame(own + [(1000 + i, t, None) for i, t in enumerate(other)] + [(2000, None, "en"), (2001, "12 34", "en")], "doc_id long, text string, lang string")
    assert {r.doc_id for r in language_id.language_stage(df).collect()} == set(range(300))
    assert language_id.language_stage(df.where("lang is null")).count() == 0  # nothing to learn from


def test_language_of_a_long_text_in_pieces(spark):
    model = language_id.ContextModel(3, {"en": [b"the cat sat on the mat and the dog ran"], "fr": [b"le chat est sur le tapis et le chien court"]})
    rng = np.random.default_rng(1)
    texts = [np.frombuffer(b" ".join(rng.choice([b"the", b"cat", b"chien", b"\xc3\xa9"], n)), np.uint8) for n in (1, 40, 3000)] + [np.zeros(0, np.uint8)]
    whole = model.bits(*language_id.padded(texts, 3))
    for piece in (1, 7, 1000, 10**6):
        assert np.allclose(model.code_lengths(texts, piece), whole, rtol=1e-5)
    tie = language_id.ContextModel(1, {"b": [b"aa"], "a": [b"aa"]})
    assert (tie.code_lengths([np.frombuffer(b"aaa", np.uint8)])[0] == tie.code_lengths([np.frombuffer(b"aaa", np.uint8)])[0][0]).all() and tie.langs == ["a", "b"]
    long = "the cat sat on the mat and the dog ran. " * 60_000  # 2.4 MB
    df = spark.createDataFrame([(i, long if i == 2 else "le chat est sur le tapis et le chien court" if i % 2 else "the cat sat on the mat", "fr" if i % 2 else "en") for i in range(40)] + [(2, long, "en")], "doc_id long, text string, lang string")
    got = language_id.language_report(df).where("doc_id = 2").collect()
    assert [r.lang_pred for r in got] == ["en", "en"]


def test_code_lengths_are_exact():
    model = language_id.ContextModel(2, {"a": [b"abab"], "b": [b"ba"]})
    one = language_id.ContextModel(0, {"a": [b"aab"]})
    data, starts = language_id.padded([np.frombuffer(b"abz", np.uint8)], 0)
    escape = np.log2(5 / 2)
    assert one.bits(data, starts)[0, 0] == pytest.approx(np.log2(5 / 2) + np.log2(5 / 1) + escape + 8, rel=1e-5)
    data, starts = language_id.padded([np.frombuffer(b"abab", np.uint8), np.frombuffer(b"", np.uint8)], 2)
    bits = model.bits(data, starts)
    assert bits[0, 0] < bits[0, 1] and (bits[1] == 0).all()


def brute_classes(texts, similarity=0.8):
    bags = []
    for t in texts:
        w = WORD.findall((t or "").translate(LOWER))
        bags.append(Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else Counter([tuple(w) or t or ""]))
    root = list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            both = sum((bags[i] & bags[j]).values())
            if both >= similarity * (sum(bags[i].values()) + sum(bags[j].values()) - both):
                a, b = root[i], root[j]
                root = [min(a, b) if x in (a, b) else x for x in root]
    return root


def test_near_duplicates(spark, docs, empty):
    rng = np.random.default_rng(3)
    base = [f"w{x}" for x in rng.integers(0, 400, 120)]
    texts = list(TEXTS)
    for k in range(40):  # copies with 0 to 6 changed words each, and some that repeat a passage
        own = list(base)
        for at in rng.choice(120, k % 7, replace=False):
            own[at] = f"new{k}x{at}"
        texts.append(" ".join(own) + (" again and again and again" * (k % 3)))
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    got = dict(map(tuple, minhash.near_classes(df).collect()))
    assert [got[i] for i in range(len(texts))] == brute_classes(texts)
    assert minhash.near_classes(empty).count() == 0
    kept = minhash.near_dedup_stage(docs)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == set(brute_classes(TEXTS))


def test_near_duplicates_of_repeated_ids_do_not_depend_on_row_order(spark):
    a, b = " ".join(f"w{i}" for i in range(80)), " ".join(f"v{i}" for i in range(80))
    rows = [(1, a), (2, b), (3, a + " end"), (4, b + " end"), (2, a), (3, b), (5, None), (6, "")]
    answers = set()
    for k in range(4):
        order = [rows[i] for i in np.random.default_rng(k).permutation(len(rows))]
        answers.add(tuple(sorted(map(tuple, minhash.near_classes(spark.createDataFrame(order, "doc_id long, text string").repartition(3)).collect()))))
    first = {i: min((t for d, t in rows if d == i), key=lambda t: hashlib.md5((t or "").encode()).digest()) for i in range(1, 7)}
    want = brute_classes([first[i] for i in range(1, 7)])
    assert answers == {tuple((i, want[i - 1] + 1) for i in range(1, 7))}


def test_near_duplicates_of_long_texts(spark):
    rng = np.random.default_rng(5)
    words = [f"w{x}" for x in rng.integers(0, 50_000, 200_000)]  # 1.3 MB
    other = list(words)
    for at in rng.choice(len(words), 2000, replace=False):
        other[at] = "changed"
    texts = [" ".join(words), " ".join(other), " ".join(words[::-1])]
    got = dict(map(tuple, minhash.near_classes(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()))
    assert got == {0: 0, 1: 0, 2: 2}


def test_bitmaps_keep_every_key(spark, empty):
    keys = spark.range(0, 3000, 3).toDF("node")
    rows = spark.range(-50, 3000).selectExpr("id as node", "'x' as bitmap", "id as bucket").union(spark.sql("select null, 'x', 1L"))
    for bits in (4, 16, 24):
        kept = common.maybe_in(rows, keys, "node", bits)
        assert kept.columns == rows.columns
        assert kept.join(keys, "node").count() == keys.count()
    assert common.maybe_in(rows, keys, "node").count() < 1020
    assert common.maybe_in(rows, keys.limit(0), "node").count() == 0


def test_spanning_links_keep_the_parts():
    rng = np.random.default_rng(1)
    a, b = rng.integers(0, 400, 300) * 7, rng.integers(0, 400, 300) * 7
    root, node = minhash.spanning(a, b)
    part = {int(x): int(x) for x in {*a.tolist(), *b.tolist()}}
    for _ in range(len(part)):
        for x, y in zip(a.tolist(), b.tolist(), strict=True):
            part[x] = part[y] = min(part[x], part[y])
    assert {x: y for x, y in part.items() if x != y} == dict(zip(node.tolist(), root.tolist(), strict=True))
    assert [len(x) for x in minhash.spanning(a[:0], b[:0])] == [0, 0]


def test_signature_estimates_weighted_similarity():
    a, b = {1: 4, 2: 1, 3: 7}, {1: 2, 2: 1, 4: 3}
    owner = np.repeat([0, 1], [3, 3])
    keys = np.array([*a, *b], np.uint64)
    tag = minhash.bag_minhash(owner, minhash.mix64(keys), np.array([*a.values(), *b.values()]), 2, 4096)
    assert (tag[0] == tag[1]).mean() == pytest.approx(3 / 15, abs=0.03)


def test_pages(spark):
    page = """<html><head><title>T</title><script>var a="</p>";</script></head><body><nav><a href=x>Menu</a></nav><div class="ad">Buy this now.</div>
    <article><h1>Head &amp; title</h1><p>The <b>first</b>  part of the text.<p>Short.</p><aside>Side</aside><div class="comments"><p>Reader says the thing.</p></div></article><footer>&copy; x</footer>"""
    pages = spark.createDataFrame([(1, "u", page, 1), (2, "v", None, 1), (3, "w", "", 1), (4, "x", "<p", 1)], "page_id long, url string, html string, text int")
    got = {r.page_id: r for r in html_extract.extract_pages(pages).collect()}
    assert got[1].text == "Head & title\n\nThe first part of the text.\n\nShort." and got[1].n_chars == len(got[1].text)
    assert got[2].text == got[3].text == got[4].text == ""


def test_pages_keep_articles_with_odd_marks():
    text = "It was the first of the long days that they had in the house by the sea, and it is not an end."
    body = f"<p>{text}</p>\n<p>{text}</p>"
    menu = "<nav><a href=x>Menu</a></nav>"
    whole = f"{text}\n\n{text}"
    for before in ("<svg class='i' />", '<math/>', '<svg title="a > b"/>', "<video src='x' />"):
        assert html_extract.main_text(f"{menu}{before}<article>{body}</article><svg><text>no</text></svg>") == whole
    for name in ("button-group", "video-card", "svg-icon"):
        assert html_extract.main_text(f"{menu}<{name}><div>{body}</div></{name}>") == whole
    for mark in ("div class='content no-sidebar'", "article class='post comments-open'", "div class='tag-social'", "main id='ad-main'", "article class='sponsored'"):
        tag = mark.split()[0]
        assert html_extract.main_text(f"<html><body>{menu}<{mark}>{body}</{tag}></body></html>") == whole
    side = f"<div class='sidebar-left'><p>{text} Side.</p></div><div class='comments'><p>{text * 9}</p></div>"
    assert html_extract.main_text(f"<div class='content no-sidebar'>{body}{side}</div>") == whole
    reply = f"<article class='comment'><p>{text} Reply.</p></article>"
    assert html_extract.main_text(f"<article class='post comments-open'>{body}{reply}</article>") == whole
    assert html_extract.main_text("<svg><text>no</text></svg><button>no</button><script src='x'/>no</script>") == ""


def test_pages_without_an_article_are_judged_by_density():
    rng = np.random.default_rng(2)
    stops, content = "the of and a to in is that it for was on".split(), "harbour window letter morning garden engine winter bridge story market".split()
    text = lambda n, share: " ".join(str(rng.choice(stops if rng.random() < share else content)) for _ in range(n)).capitalize() + "."
    good = [text(60, 0.45), text(20, 0.4), "A short line.", text(80, 0.5)]
    junk = [text(60, 0.03), text(25, 0.0)]
    links = "<div>" + "".join(f"<a href=x><span>{w} and the rest of it all in one long link of many words of the page</span></a> " for w in content) + "</div>"
    page = links + "".join(f"<div><p>{x}</p></div>" for x in good) + "".join(f"<div>{x}</div>" for x in junk) + links
    want = "\n\n".join(good)
    assert html_extract.main_text(page) == want
    assert html_extract.main_text(page, stops_low=0, stops_high=0) == "\n\n".join(good + junk) and html_extract.main_text(page, stops_low=2, stops_high=2) == ""
    assert html_extract.main_text(page, short=1000) == ""  # nothing decided but the links
    marked = page.replace(f"<div><p>{good[0]}", f"<main><div><p>{good[0]}").replace(f"{good[3]}</p></div>", f"{good[3]}</p></div></main>")
    assert html_extract.main_text(marked) == want
    assert html_extract.main_text("<div><p>" + "我们在这里说的是一个很长的故事，他也就是这样的人。" * 15 + "</p></div>").count("故事") == 15
    assert html_extract.main_text("<div>" + "ẹ̀dá ènìyàn náà ṣiṣẹ́ púpọ̀ " * 20 + "</div>").count("ènìyàn") == 20  # a language that is not known here


def test_pages_keep_articles_with_weak_words():
    text = "It was the first of the long days that they had in the house by the sea, and it is not an end."
    body, whole = f"<p>{text}</p><p>{text}</p>", f"{text}\n\n{text}"
    assert html_extract.main_text(f"<main><section id='related-work'>{body}</section></main>") == whole
    assert html_extract.main_text(f"<article>{body}<p class='share-price'>{text}</p></article>") == f"{whole}\n\n{text}"
    assert html_extract.main_text(f"<div class='widget'>{body}</div><footer>x</footer>") == whole
    for out in ("<div class='related-posts'><a href=x><div>{}</div></a></div>", "<div class='widget'>{}</div>", "<p class='notice'>{}</p>", "<a href=x><div><p>{}</p></div></a>"):
        assert html_extract.main_text(f"<main>{body}{out.format(text)}</main>") == whole
    for tag in ("title-bar", "style-guide", "select-list"):
        assert html_extract.main_text(f"<{tag}>x</{tag}><main>{body}</main>") in (whole, f"x\n\n{whole}")


def test_pages_of_great_depth_and_length(spark):
    text = "It was the first of the long days that they had in the house by the sea, and it is not an end."
    began = time.time()
    for mark in ("", " class='no-nav'"):
        assert html_extract.main_text(f"<div{mark}>" * 20_000 + f"<p>{text}</p>" + "</div>" * 20_000) == text
    long = "<article>" + f"<p>{text}</p>" * 20_000 + "</article>"  # 2 MB
    assert html_extract.main_text(long).count(text) == 20_000 and time.time() - began < 60
    rows = [(1, "u", long, "x"), (1, "u", long, "x"), (None, None, "<p>x", "y")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = html_extract.extract_pages(df).collect()
    assert [r.n_chars for r in got if r.page_id] == [len(html_extract.main_text(long))] * 2 and html_extract.extract_pages(df.limit(0)).count() == 0


def test_licenses(docs, empty):
    got = {r.doc_id: r for r in license_scan.scan_licenses(docs).collect()}
    for i, t in enumerate(TEXTS):
        w = WORD.findall((t or "").translate(LOWER))
        at = [k for p, _ in license_scan.BASE for k in range(len(w)) if w[k : k + len(p.split())] == p.split()]
        assert (got[i].n_words, got[i].n_base, got[i].first_word, got[i].last_word) == (len(w), len(at), min(at, default=None), max(at, default=None))
    assert got[8].labels == "mit" and got[9].base_labels == "cc-by,reserved" and got[10].labels == "gpl,gpl-3.0" and got[5].labels == ""
    assert license_scan.scan_licenses(empty).count() == 0


def test_licenses_do_not_displace_each_other(spark):
    notices = [text for _, text, _ in license_scan.TEMPLATES]
    texts = ["\n\nother words here\n\n".join(notices), "\n".join([notices[2], notices[4], notices[0], notices[9]]), *notices]
    got = {r.doc_id: r for r in license_scan.scan_licenses(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    more = {i: set(got[i].labels.split(",")) - {"cc-by", "reserved"} for i in got}
    assert more[0] == {label for label, _, _ in license_scan.TEMPLATES} and got[0].score == 1.0
    assert more[1] - {"gpl"} == {"apache-2.0", "gpl-3.0", "mit", "cc-by-nc"} and got[1].score == 1.0
    assert all(label in more[i] for i, (label, _, _) in enumerate(license_scan.TEMPLATES, 2))


def brute_licenses(texts, look_up=8, least=0.6):
    words = [WORD.findall((t or "").translate(LOWER)) for t in texts]
    rare = [[w for w in x.split() if w not in license_scan.COMMON] for _, x, _ in license_scan.TEMPLATES]
    often = Counter(w for own in words for w in set(own) & {w for r in rare for w in r})
    holds = lambda own, p: any(own[i : i + len(p)] == p for i in range(len(own)))
    for own in words:
        base = {label for p, label in license_scan.BASE if holds(own, p.split())}
        labels, best = set(base), 0.5 if base else 0.0
        for r, (label, x, needed) in zip(rare, license_scan.TEMPLATES, strict=True):
            chosen = set(sorted(set(r), key=lambda w: (often[w], w))[:look_up])
            at = {}
            for i, w in enumerate(own):
                for j, v in enumerate(x.split()):
                    if w == v and w in chosen:
                        at.setdefault(i - j, set()).add(w)
            share = max(map(len, at.values()), default=0) / len(chosen)
            if share >= least and all(holds(own, p.split()) for p in needed):
                labels.add(label)
                best = max(best, share)
        yield ",".join(sorted(base)), ",".join(sorted(labels)), best


def test_licenses_against_brute_force(spark):
    rng = np.random.default_rng(3)
    notices = [x.split() for _, x, _ in license_scan.TEMPLATES] + [p.split() for p, _ in license_scan.BASE]
    texts = [None, "", "SPDX-License-Identifier: MIT", "// SPDX-License-Identifier: Apache-2.0", "under Apache-2.0, see there"]
    for _ in range(150):
        own = []
        for _ in range(rng.integers(0, 4)):
            x = list(notices[rng.integers(len(notices))])
            for k in rng.integers(0, len(x), rng.integers(0, 3)):  # some words lost or changed
                x[k] = str(rng.choice(["", "other", "license", "software"]))
            own += x + [str(w) for w in rng.choice(["the", "software", "house", "public", "version", "copy"], rng.integers(0, 6))]
        texts.append(" ".join(own))
    texts += [texts[-1], " ".join(["house software"] * 100_000 + ["released under the MIT license"])]  # a repeat and 1.5 MB
    got = {r.doc_id: (r.base_labels, r.labels, r.score) for r in license_scan.scan_licenses(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)).collect()}
    want = list(brute_licenses(texts))
    assert [got[i] for i in range(len(texts))] == want
    assert [got[i][1] for i in (2, 3, 4)] == ["mit", "apache-2.0", "apache-2.0"] and got[len(texts) - 1][1] == "mit"


def test_fingerprints(docs, empty):
    got = {r.doc_id: r for r in spotsigs.fingerprint_report(docs).collect()}
    n = len(TEXTS)
    for i, t in enumerate(TEXTS):
        t, after = t or "", TEXTS[(i + 1) % n] or ""
        edited = t[: len(t) - len(t) // 4] + after[: len(t) // 4]
        assert got[i].n_chars == len(t) and got[i].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
    assert got[5].fingerprint == got[6].fingerprint and got[5].near_next == 1.0 and got[6].near_next > 0.8
    assert spotsigs.fingerprint_report(empty).count() == 0


def test_nearest(spark):
    rng = np.random.default_rng(5)
    x = rng.standard_normal((600, 16))
    x[300:400] = x[300]  # a third of ties
    rows = [(i, [float(v) for v in y], 1.0) for i, y in enumerate(x)] + [(1001, None, 1.0), (1020, [0.0] * 16, 1.0), (1040, [float("nan")] * 16, 1.0), (1060, [1.0], 1.0)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, score double")
    got = mih.nearest(df, shard_rows=200, most_rows=150).collect()
    hit = 0
    for q in range(0, 600, 20):
        score = (x * x[q]).sum(axis=1)
        score[q] = -np.inf
        best = np.lexsort((np.arange(600), -score))[:20].tolist()
        own = sorted((r.rank, r.vec_id, r.score) for r in got if r.query_id == q)
        assert [r[0] for r in own] == list(range(1, 21)) and all(r[2] == score[r[1]] for r in own)
        hit += len(set(best) & {r[1] for r in own})
    assert hit >= 0.9 * 600 and mih.nearest(df.where("vec_id < 0")).count() == 0


def test_nearest_of_repeated_rows_and_huge_entries(spark):
    """Each row of a repeated query has 20 neighbours of its own, among them the other row."""
    rng = np.random.default_rng(6)
    x = rng.standard_normal((60, 8))
    rows = [(i, x[i].tolist()) for i in range(60)] + [(20, x[20].tolist())]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    own = sorted(((r.rank, r.vec_id) for r in mih.nearest(df, recall=1.0).collect() if r.query_id == 20))
    assert [r for r, _ in own] == sorted([*range(1, 21)] * 2)
    score = np.append(x @ x[20], x[20] @ x[20])
    ids = [*range(60), 20]
    want = [ids[i] for i in np.lexsort((ids, -score)) if i != 20][:20]
    assert [v for _, v in own[::2]] == want == [v for _, v in own[1::2]] and want.count(20) == 1
    few = mih.nearest(df.where("vec_id < 5 or vec_id = 20")).collect()
    assert sum(r.query_id == 0 for r in few) == 6 and sum(r.query_id == 20 for r in few) == 12
    huge = spark.createDataFrame([(0, [1e200, 1.0]), (1, [-1e200, 2.0]), (2, [1e200, -1e200]), (3, [3.0, 4.0])], "vec_id long, embedding array<double>")
    assert [(r.rank, r.vec_id) for r in sorted(mih.nearest(huge).collect())] == [(1, 2), (2, 3), (3, 1)]


def searched(coder, x, asked, k):
    index = mih.MultiIndex(coder, np.arange(len(x)), np.arange(len(x)), x)
    codes = coder.codes(x[asked], True)
    return [index.nearest(q, x[q], c, k)[0] for q, c in zip(asked, codes, strict=True)], index.touched


def test_index_meets_few_rows():
    rng = np.random.default_rng(8)
    x = rng.standard_normal((40_000, 64))
    x /= np.linalg.norm(x, axis=1)[:, None]  # uniform on a sphere: the hardest case
    asked = np.arange(0, len(x), 200)
    score = x[asked] @ x.T
    score[np.arange(len(asked)), asked] = -9
    best = np.argsort(-score, axis=1)[:, :20]
    coder = mih.fit(x[:8_000], 1.0, 1.0, 2048, 16, max(1, 20 * 8_000 // 40_000), 0.94)
    got, touched = searched(coder, x, asked, 20)
    hit = sum(len(set(b) & set(own)) for b, own in zip(best, got, strict=True))
    assert hit >= 0.9 * best.size and touched < 0.2 * len(asked) * len(x)
    near = x[:4_000] + 0.05 * rng.standard_normal((4_000, 64))  # neighbours that are near: few rows in any bucket
    both = np.concatenate([x[:4_000], near])
    scale = np.abs(both).max()
    coder = mih.fit(both, scale, float(((both / scale) ** 2).sum(axis=1).max()), 2048, 16, 1, 0.94)
    got, touched = searched(coder, both, np.arange(400), 1)
    assert np.mean([own[0] == q + 4_000 for q, own in enumerate(got)]) > 0.9 and touched < 0.02 * 400 * 8_000


def test_every_code_within_the_radius_is_met():
    rng = np.random.default_rng(2)
    x = rng.standard_normal((500, 6))
    coder = mih.fit(x, 1.0, 100.0, 32, 8, 5, 0.9)
    coder.parts = 4
    index = mih.MultiIndex(coder, np.arange(500), np.arange(500), x)
    codes = coder.codes(x, False)
    for flips in (0, 1, 2, 8):
        gap = np.bitwise_count(codes[:40, None] ^ codes[None])
        for q in range(40):
            met = np.zeros(500, bool)
            met[index.met(codes[q], flips)] = True
            assert (met == (gap[q].min(axis=1) <= flips)).all() and met[gap[q].sum(axis=1) < 4 * (flips + 1)].all()


def test_rows_moved_grow_with_the_table(spark):
    """On one cluster every row goes to one shard and every query to as many as there are shards."""
    moved = []
    for n in (2_000, 8_000):
        df = spark.range(n).selectExpr("id as vec_id", "transform(sequence(1, 8), i -> cast(hash(id, i) / 1e9 as double)) as embedding")
        plan = mih.nearest(df, shard_rows=500)
        text = plan._jdf.queryExecution().executedPlan().toString()
        assert "Cartesian" not in text and "NestedLoop" not in text
        assert plan.count() == n // 20 * 20
        moved.append(n + n // 20 * min(-(-n // 500), spark.sparkContext.defaultParallelism))
    assert moved[1] <= 4 * moved[0]


def brute_spots(text, chain=2):
    words = WORD.findall((text or "").translate(LOWER))
    after, out = [], set()
    for w in reversed(words):
        if w not in spotsigs.ANCHORS:
            after = [w, *after[: chain - 1]]
        elif len(after) == chain:
            out.add((w, *after))
    return out or {tuple(words) or (text or "",)}


def test_fingerprints_against_brute_force(spark):
    rng = np.random.default_rng(11)
    vocabulary = "the of and a to river stone paper window letter le la des maison Haus über 日本 x1".split()
    texts = [*TEXTS, *(" ".join(rng.choice(vocabulary, rng.integers(0, 80))) for _ in range(60))]
    texts += [texts[-1], texts[-1] + " and the river stone", " ".join(rng.choice(vocabulary, 300_000))]  # copies and 1.5 MB
    ids = [3 * i for i in range(len(texts))]
    df = spark.createDataFrame(list(zip(ids, texts, ["c"] * len(ids), strict=True)), "doc_id long, text string, spots string").repartition(5)
    got = {r.doc_id: r for r in spotsigs.fingerprint_report(df).collect()}
    like = lambda a, b: len(a & b) / len(a | b)
    same = {}
    for i, t in zip(ids, texts, strict=True):
        t, after = t or "", texts[(i // 3 + 1) % len(texts)] or ""
        edited = t[: len(t) - len(t) // 4] + after[: len(t) // 4]
        a, b, c = brute_spots(t), brute_spots(edited), brute_spots(after)
        assert got[i].near_edited == pytest.approx(like(a, b)) and got[i].near_next == pytest.approx(like(a, c))
        assert len(got[i].fingerprint.split()) == len(a) and len(got[i].edited_fingerprint.split()) == len(b)
        assert same.setdefault(frozenset(a), got[i].fingerprint) == got[i].fingerprint
    assert len(set(same.values())) == len(same)
    assert {r.doc_id: r.class_id for r in got.values()} == classes_of(ids, [brute_spots(t) for t in texts], 0.8)


def test_fingerprints_of_one_document_repeats_and_null_ids(spark):
    kind = "doc_id long, text string"
    one = spotsigs.fingerprint_report(spark.createDataFrame([(4, "the river stone paper")], kind)).collect()
    assert [(r.doc_id, r.near_next, r.n_chars, r.class_id) for r in one] == [(4, 1.0, 21, 4)]
    rows = [(1, "a b c d"), (1, "a b c d"), (None, "the river stone"), (2, None)]
    got = spotsigs.fingerprint_report(spark.createDataFrame(rows, kind)).collect()
    assert sorted(r.n_chars for r in got) == [0, 7, 7, 15] and len({r.fingerprint for r in got if r.doc_id == 1}) == 1
    assert {(r.doc_id, r.class_id) for r in got} == {(1, 1), (2, 2), (None, None)}


def classes_of(ids: list, sets: list, similarity: float) -> dict:
    """The smallest id of what chains of sets of at least this Jaccard similarity connect, by id."""
    root = dict(zip(ids, ids, strict=True))
    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if len(a & b) >= similarity * len(a | b) and root[ids[i]] != root[ids[j]]:
                low, high = sorted((root[ids[i]], root[ids[j]]))
                root = {k: low if v == high else v for k, v in root.items()}
    return root


def test_spot_classes_against_brute_force(spark, empty):
    rng = np.random.default_rng(5)
    phrase = lambda: f"the {' '.join(rng.choice(400, 2).astype(str))}"
    texts = [*TEXTS, *(" ".join(phrase() for _ in range(rng.integers(1, 12))) for _ in range(60))]
    for parts, copies in ((20, 40), (9, 30), (5, 30)):  # chains of copies of copies, each edited, shortened or lengthened
        family = [[phrase() for _ in range(parts)]]
        for _ in range(copies):
            own = list(family[rng.integers(len(family))])
            for _ in range(rng.integers(0, 4)):
                own[rng.integers(len(own))] = phrase()
            family.append((own + [phrase()])[rng.integers(0, 2) :])
        texts += [" ".join(x) for x in family]
    ids = [int(x) for x in rng.permutation(len(texts)) * 2]
    rows = list(zip(ids, texts, ["c"] * len(ids), strict=True))
    df = spark.createDataFrame([*rows, rows[3], (None, "the river stone", "c")], "doc_id long, text string, class string").repartition(5)
    want = classes_of(ids, [brute_spots(t) for t in texts], 0.8)
    assert 40 < len(set(want.values())) < len(ids) - 40
    for rounds in (3, 0):
        got = spotsigs.spot_classes(df, rounds=rounds).collect()
        assert len(got) == len(ids) and {r.doc_id: r.class_id for r in got} == want
    assert spotsigs.spot_classes(empty, rounds=1).count() == 0
