"""Whitening, SimHash and fill-in-middle against brute force, with nulls, empties, repeats, ties and odd columns."""

import hashlib
import re
import zlib
from fractions import Fraction

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
import xxhash
from tokenizers import Tokenizer

import corpus_pipeline
from sketchloom.llm import fill_in_middle as fim
from sketchloom.llm import html_extract, language_id, packing, piece_bpe, simhash, spotsigs, url_filter, whitening

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


# --- whitening ------------------------------------------------------------------------------------
def whole(v):
    return tuple(int(np.floor(256 * float(np.float32(c)))) for c in v)


def whitened_by_hand(vectors, components=4):
    """n, sums, eigenvalues and components of the distinct vectors' exact covariance."""
    x = sorted(set(vectors))
    n = len(x)
    sums = [sum(v[i] for v in x) for i in range(len(x[0]))]
    away = [[n * c - s for c, s in zip(v, sums, strict=True)] for v in x]
    cov = np.array([[float(Fraction(sum(a[i] * a[j] for a in away), n**3)) for j in range(len(sums))] for i in range(len(sums))])
    e, axes = np.linalg.eigh(cov)
    return n, sums, e[::-1][:components], axes[:, ::-1][:, :components], cov.trace()


def check_whitened(rows, vectors, ids):
    n, sums, e, axes, total = whitened_by_hand(vectors)
    got = {}
    for r in rows:
        got.setdefault(r.vec_id, {})[r.component] = r
    assert set(got) == set(ids)
    for k in range(len(e)):
        x = np.array([[float(Fraction(n * c - s, n)) for c, s in zip(v, sums, strict=True)] for v in vectors])
        want = x @ axes[:, k] / np.sqrt(e[k])
        mine = np.array([got[i][k + 1].whitened for i in ids])
        assert min(np.abs(mine - want).max(), np.abs(mine + want).max()) < 1e-8
    for i, v in zip(ids, vectors, strict=True):
        for k, r in got[i].items():
            assert r.n == n and r.deviation == sum((n * c - s) ** 2 for c, s in zip(v, sums, strict=True))
            assert abs(r.explained - e[k - 1] / total) < 1e-9 and 0 <= r.identity_error < 1e-9


def test_whitening_against_exact_covariance(spark):
    rng = np.random.default_rng(3)
    v = (rng.standard_normal((120, 7)) @ rng.standard_normal((7, 7)) + 3).astype(np.float32)
    v[60:90] = v[5]  # copies have no weight
    rows = [(i, x.tolist(), "c", 1.0) for i, x in enumerate(v)]
    bad = [(900, None, "c", 1.0), (901, [1.0] * 6 + [float("nan")], "c", 1.0), (902, [1.0] * 6 + [None], "c", 1.0), (903, [float("inf")] + [1.0] * 6, "c", 1.0), (904, [], "c", 1.0), (905, [1.0, 2.0], "c", 1.0)]
    df = spark.createDataFrame(rows + bad, "vec_id long, embedding array<float>, component string, x double").repartition(5)
    got = whitening.whiten(df).collect()
    assert len(got) == 120 * 4
    check_whitened(got, [whole(x) for x in v], list(range(120)))


def test_whitening_of_few_dimensions_and_low_rank(spark):
    schema = "vec_id long, embedding array<double>"
    flat = spark.createDataFrame([(i, [float(i), 2.0 * i, 5.0, float(i % 3)]) for i in range(30)], schema)
    got = whitening.whiten(flat).collect()
    assert {r.component for r in got} == {1, 2} and len(got) == 60  # two directions vary
    assert abs(sum(r.explained for r in got if r.vec_id == 0) - 1) < 1e-12 and got[0].identity_error < 1e-9
    one = spark.createDataFrame([(i, [float(i * i)]) for i in range(9)], schema)
    assert len(whitening.whiten(one).collect()) == 9
    assert whitening.whiten(spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 2.0])], schema)).collect() == []
    assert whitening.whiten(spark.createDataFrame([], schema)).columns == whitening.whiten(flat).columns


def test_whitening_of_a_bad_condition(spark):
    """Standard deviations from 1 to 10^8 in turned axes."""
    rng = np.random.default_rng(5)
    turn = np.linalg.qr(rng.standard_normal((5, 5)))[0]
    v = (rng.standard_normal((200, 5)) * np.array([1e8, 1e6, 1e4, 1e2, 1.0])) @ turn.T
    got = whitening.whiten(spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "vec_id long, embedding array<double>"), components=5).collect()
    assert len(got) == 1000 and got[0].identity_error < 1e-6


def test_whitening_of_huge_entries_and_repeated_ids(spark):
    rows = [(1, [1e300, 0.5]), (1, [-1e300, 0.25]), (None, [2.0, 3.0]), (4, [2.0, 3.0])]
    got = whitening.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    assert {r.vec_id for r in got} == {1, None, 4} and all(r.n == 3 for r in got)
    assert all(r.deviation is None for r in got if r.vec_id == 1)  # no long holds it


# --- SimHash --------------------------------------------------------------------------------------
def print_by_hand(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    runs = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    marks = [xxhash.xxh64_intdigest(x.encode(), 42) for x in runs]
    return sum(1 << b for b in range(64) if sum(m >> b & 1 for m in marks) * 2 > len(marks)) if marks else 0


def parts_by_hand(prints, distance=4):
    part = list(range(len(prints)))
    for i in range(len(prints)):
        for j in range(i):
            if part[i] != part[j] and (prints[i] ^ prints[j]).bit_count() <= distance:
                low, high = sorted((part[i], part[j]))
                part = [low if x == high else x for x in part]
    return part


def test_simhash_against_brute_force(spark):
    rng = np.random.default_rng(1)
    words = [f"w{i}" for i in range(400)] + ["É", "日本", "A\xa0b"]
    base = [[str(rng.choice(words)) for _ in range(150)] for _ in range(25)]
    texts = [None, "", " \t\n", "One", "one", "a b", "A\x0bB c", "a b c d", "x\x1fy z\x00 q"]
    for b in base:
        texts += [" ".join(b), "  ".join(b).upper()]
        for n in (1, 2, 4):
            copy = list(b)
            for at in rng.integers(0, len(copy), n):
                copy[at] = "changed"
            texts.append("\n".join(copy))
    rows = [(1000 - i if i % 9 else 500, t, "f", "c") for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string, fingerprint string, class string").repartition(7)
    got = simhash.simhash_components(df)
    assert got.columns == ["doc_id", "fingerprint", "component_id"]
    prints = [print_by_hand(t) for t in texts]
    part = parts_by_hand(prints)
    least = {p: min(r[0] for r, q in zip(rows, part, strict=True) if q == p) for p in part}
    want = sorted((r[0], f"{f:016x}", least[p]) for r, f, p in zip(rows, prints, part, strict=True))
    assert sorted(map(tuple, got.collect())) == want
    assert len(set(part)) < len(set(prints))  # some differ and are linked


@pytest.mark.parametrize("block", [65_536, 64])
def test_ring_links_lose_no_link(spark, block):
    """Random fingerprints, chains of them and dense balls, in whole buckets and in blocks that meet."""
    rng = np.random.default_rng(2)
    prints = {int(x) for x in rng.integers(0, 1 << 63, 800, dtype=np.uint64)}
    for centre in list(prints)[:30]:
        x = centre
        for _ in range(8):  # each step of exactly 4 or 5 bits
            for b in rng.choice(64, rng.integers(4, 6), replace=False):
                x ^= 1 << int(b)
            prints.add(x)
    for _ in range(500):
        x = 0x0123456789ABCDEF
        for b in rng.choice(64, 3, replace=False):
            x ^= 1 << int(b)
        prints.add(x)
    prints = sorted(prints)
    signed = [x - (1 << 64) if x >> 63 else x for x in prints]
    links = simhash.near_links(spark.createDataFrame([(x,) for x in signed], "fp long").repartition(3), 4, block).collect()
    assert all(((r.a ^ r.b) & (1 << 64) - 1).bit_count() >= 1 for r in links)
    part = {x: x for x in signed}

    def root(x):
        while part[x] != x:
            x = part[x]
        return x

    for r in links:
        part[root(r.a)] = root(r.b)
    mine = [root(x) for x in signed]
    want = parts_by_hand(prints)
    assert len(set(zip(mine, want, strict=True))) == len(set(want)) == len(set(mine))


def test_simhash_of_a_long_text_in_pieces():
    text = " ".join(f"Word{i % 977}" for i in range(20_000))
    assert simhash.fingerprint(text.encode()) == print_by_hand(text)
    whole, pieces = (np.concatenate(list(simhash.shingle_hashes(text.encode(), 4, 42, p))) for p in (1 << 22, 1000))
    assert (whole == pieces).all() and len(whole) == 19_997
    assert [len(h) for h in simhash.shingle_hashes(b"a b c", 4, 42, 2)] == [1]


def test_simhash_without_rows_and_without_ids(spark):
    schema = "doc_id long, text string"
    assert simhash.simhash_components(spark.createDataFrame([], schema)).collect() == []
    got = simhash.simhash_components(spark.createDataFrame([(None, "same text"), (None, "another one"), (3, "same text")], schema)).collect()
    assert sorted((r.doc_id or 0, r.component_id or 0) for r in got) == [(0, 0), (0, 3), (3, 3)]


# --- fill in middle -------------------------------------------------------------------------------
UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def fim_by_hand(doc_id, text):
    text = text or ""
    units = UNIT.findall(text)
    mark = hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(mark[i : i + 8], 16) for i in range(0, 32, 8))
    n = len(units)
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h3 % 100 >= 50:
        return n, "plain", None, None, text
    if h4 % 100 < 80:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def test_fill_in_middle_against_brute_force(spark):
    rng = np.random.default_rng(4)
    texts = [None, "", " ", "\n\n x", "x \t", "has <P> in it", "<S", "<<S>M>", "a<P", "> b<", "日本 語\x0b🙂 é\x1c\x85z"]
    texts += ["".join(rng.choice(list("ab <PSM>\n\té🙂"), rng.integers(1, 60))) for _ in range(400)]
    texts += ["long words " * 30_000]
    rows = [(None if i == 7 else i // 2 if i % 50 == 0 else i, t, "o") for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string, output string").repartition(3)
    got = fim.fill_in_middle(df).collect()
    key = lambda r: (-1 if r[0] is None else r[0], r[1])
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    want = sorted(((i, *(w := fim_by_hand(i, t)), sha(w[4]), sha(t or "")) for i, t, _ in rows), key=lambda r: (-1 if r[0] is None else r[0], r[6], r[7]))
    mine = sorted(map(tuple, got), key=lambda r: (-1 if r[0] is None else r[0], r[6], r[7]))
    assert mine == want and key(mine[0])[0] == -1
    forms = {r.form for r in got}
    assert forms == {"plain", "psm", "spm"}
    assert fim.fill_in_middle(df, with_output=False).columns == ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256"]
    assert fim.fill_in_middle(df.limit(0)).count() == 0


def test_piece_table_cuts_arranges_and_restores():
    table = fim.PieceTable((b"hello world",), [(0, 0, 11)])
    parts = table.cut(5, 5)
    assert parts.pieces == [(0, 0, 5), (0, 5, 0), (0, 5, 6)] and parts.text() == b"hello world"
    assert parts.arranged((2, 0, 1)).text() == b" worldhello" and parts.arranged((2, 0, 1)).put_back((2, 0, 1)).pieces == parts.pieces
    assert parts.arranged((2, 1, 0)).sha256() == hashlib.sha256(b" worldhello").hexdigest()
    again = parts.cut(0, 3, 7, 11)  # descriptors that are cut again
    assert again.text() == b"hello world" and [p for p in again.pieces if p[2]] == [(0, 0, 3), (0, 3, 2), (0, 5, 2), (0, 7, 4)]


def test_units_in_pieces_of_a_text():
    data = " ab  c\n\nd e ".encode() * 50
    ends = [m.end() for m in re.finditer(rb"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+", data)]
    for step in (1, 2, 3, 7, 1 << 24):
        assert np.concatenate(list(fim.units(data, step))).tolist() == ends
    assert fim.ends_at(data, [0, 0, 1, len(ends)]) == [0, 0, ends[0], len(data)]


# --- HTML without marks ---------------------------------------------------------------------------
PROSE = "The house of the river is old and it was built by the people of the town in a time of which there is no book to read. "


def bare_page(blocks):
    return "<html><body>" + "".join(f"<div>{b}</div>" for b in blocks) + "</body></html>"


def test_density_and_links_decide_where_no_mark_does():
    menu = "".join(f'<a href="/{i}">Topic number {i} of this site</a> ' for i in range(8))
    odd = "Zorvan | quelt | brimdo | parnek | voltis | krendal | sompre | valdik | morentu | celdra"  # a table row without a stop word
    blocks = [menu, PROSE * 3, odd, PROSE, "A short line", PROSE * 2, menu]
    want = [" ".join(x.split()) for x in (PROSE * 3, odd, PROSE, "A short line", PROSE * 2)]
    got = html_extract.main_text(bare_page(blocks)).split("\n\n")
    assert got == want
    # the results move with each limit
    assert html_extract.main_text(bare_page(blocks), stops_low=2, stops_high=2) == ""
    assert html_extract.main_text(bare_page(blocks), most_linked=2) != "\n\n".join(want)
    assert odd not in html_extract.main_text(bare_page([menu, odd, menu]))  # between blocks of links a row without stop words is out
    assert html_extract.main_text(bare_page([odd])) == odd and html_extract.main_text(bare_page(["Short", "lines"])) == "Short\n\nlines"
    assert html_extract.main_text(bare_page([PROSE * 2, "Note", "Imprint", menu])).endswith(" read.\n\nNote")
    assert html_extract.main_text(bare_page([PROSE * 2, menu, "Note", menu, menu])) == " ".join((PROSE * 2).split())


# --- repeated rows, empty tables and long texts of earlier operators ------------------------------
def test_pieces_and_packing_of_repeated_rows_and_long_texts(spark):
    schema = "doc_id long, text string, source string"
    long = "Ünïcode words and 12,345 numbers, again and again. " * 12_000
    df = spark.createDataFrame([(1, "the same row", "s"), (1, "the same row", "s"), (2, long, "s"), (3, None, None)], schema).repartition(3)
    lib = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    got = [(r.doc_id, r.n_tokens) for r in piece_bpe.encode_documents(df, public_tokenizers.path("piece_bpe_32k.model")).collect()]
    assert sorted(got) == sorted([(1, len(lib.encode("the same row")))] * 2 + [(2, len(lib.encode(long))), (3, 0)])
    words = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    rows = packing.pack(df, public_tokenizers.path("word_bpe_49k.json")).collect()
    held = {}
    for r in rows:
        held.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in held.values():  # without gaps or overlaps
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048
    ids = [*words.encode(long, add_special_tokens=False).ids, 1]
    own = sorted((r.start, r.length, r.ids_crc32) for r in rows if r.doc_id == 2)
    assert sum(n for _, n, _ in own) == len(ids) and all(zlib.crc32(np.array(ids[s : s + n], "<u4").tobytes()) == c for s, n, c in own)
    one = len(words.encode("the same row", add_special_tokens=False).ids) + 1
    assert sum(r.length for r in rows if r.doc_id == 1) == 2 * one and sum(r.length for r in rows if r.doc_id == 3) == 1
    for df in (piece_bpe.encode_documents(df.limit(0), public_tokenizers.path("piece_bpe_32k.model")), packing.pack(df.limit(0), public_tokenizers.path("word_bpe_49k.json"))):
        assert df.count() == 0


def test_urls_of_great_length_and_empty_tables(spark):
    schema = "page_id long, url string, host string, rule string"
    far = "https://" + "sub." * 20_000 + "example.net/en/" + "x" * 200_000 + "?q=" + "y" * 100_000
    df = spark.createDataFrame([(1, far, "h", "r"), (1, far, "h", "r"), (2, None, None, None)], schema)
    got = url_filter.url_filter_report(df).collect()
    assert [(r.rule, r.verdict) for r in got if r.page_id == 1] == [("example.net/en/", "allow")] * 2
    assert url_filter.url_filter_report(df.limit(0)).count() == 0


def test_pipeline_of_an_empty_table_and_of_repeated_ids(spark, tmp_path):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame([], schema).write.parquet(f"{tmp_path}/a/documents.parquet")
    assert corpus_pipeline.run(spark, f"{tmp_path}/a").collect() == []
    english = "the house of the river is old and it was built by the people of the town in a time of which there is no book "
    rows = [(i, english + f"and number {i} of them is here for all to see by day and by night " * 3, "en", "s", 1) for i in range(20)]
    rows += [rows[3], (3, english * 2 + "with an end of its own for the same number", "en", "s", 1), (None, english + "without a number but with words of its own", "en", "s", 1)]
    spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/b/documents.parquet")
    got = corpus_pipeline.run(spark, f"{tmp_path}/b").collect()
    assert {r.doc_id for r in got} <= {*range(20), None} and sum(r.doc_id == 3 for r in got) >= 1


# --- language ID ----------------------------------------------------------------------------------
def brute_code_length(order, samples, text):
    """Bits of a text by partial matching, symbol by symbol, over dictionaries of counts."""
    counts = {}
    for sample in samples:
        data = b"\n" * order + sample
        for i in range(order, len(data)):
            for k in range(order + 1):
                own = counts.setdefault(data[i - k : i], {})
                own[data[i]] = own.get(data[i], 0) + 1
    bits, data = 0.0, b"\n" * order + text
    for i in range(order, len(data)):
        for k in range(order, -2, -1):
            if k < 0:
                bits += 8  # uniform bytes
                break
            own = counts.get(data[i - k : i], {})
            n, d = sum(own.values()), len(own)
            if data[i] in own:
                bits += np.log2((n + d) / own[data[i]])
                break
            bits += np.log2((n + d) / d) if d else 0
    return bits


@pytest.mark.parametrize("order", [0, 1, 3])
def test_code_lengths_against_brute_force(order):
    rng = np.random.default_rng(order)
    draw = lambda letters, n: bytes(rng.choice(list(letters), n).astype(np.uint8))
    samples = {"a": [draw(b"abc \n", 300), draw(b"abc", 40)], "b": [draw(b"bcd ", 200)], "c": [b"\xff"]}
    texts = [draw(b"abcd \nxyz", n) for n in (1, 2, 50, 400)] + [b"", b"\n\n\n", b"\xff\xff\x00"]
    model = language_id.ContextModel(order, samples)
    for piece in (2_000_000, 7):
        got = model.code_lengths([np.frombuffer(x, np.uint8) for x in texts], piece)
        want = [[brute_code_length(order, samples[lang], x) for lang in model.langs] for x in texts]
        assert np.allclose(got, want, rtol=1e-4, atol=1e-3)


def test_spot_classes_of_a_group_of_near_copies(spark, monkeypatch):
    """Copies of one text that are hardly alike among themselves: classes are exact, few pairs are met and only their sets are kept."""
    rng = np.random.default_rng(9)
    phrase = lambda: ("the", *(f"w{x}" for x in rng.integers(0, 10**6, 2)))
    base, texts = [phrase() for _ in range(40)], []
    for _ in range(240):
        own = list(base)
        for at in rng.choice(40, rng.integers(1, 7), replace=False):
            own[at] = phrase()
        texts.append(own)
    texts += [[phrase() for _ in range(20)] for _ in range(300)]
    sets = [frozenset(x) for x in texts]
    root = list(range(len(sets)))
    for i, a in enumerate(sets[:240]):
        for j in range(i):
            if len(a & sets[j]) >= 0.8 * len(a | sets[j]) and root[i] != root[j]:
                low, high = sorted((root[i], root[j]))
                root = [low if x == high else x for x in root]
    tables = {}
    keep = spotsigs.written

    def recorded(df, name):
        out = keep(df, name)
        tables.setdefault(name, []).append(out.count())
        return out

    monkeypatch.setattr(spotsigs, "written", recorded)
    df = spark.createDataFrame([(i, " ".join(" ".join(p) for p in x)) for i, x in enumerate(texts)], "doc_id long, text string")
    store = spark._jsparkSession.sharedState().statusStore()
    done = store.executionsCount()
    got = {r.doc_id: r.class_id for r in spotsigs.spot_classes(df).collect()}
    assert got == dict(enumerate(root)) and 1 < len(set(root[:240])) < 200
    most, runs = 0, store.executionsList()
    for run in (runs.apply(k) for k in range(runs.size())):
        if run.executionId() < done:
            continue
        values, nodes = store.executionMetrics(run.executionId()), store.planGraph(run.executionId()).allNodes()
        for node in (nodes.apply(k) for k in range(nodes.size())):
            for m in (node.metrics().apply(k) for k in range(node.metrics().size())) if "Join" in node.name() else ():
                if m.name() == "number of output rows" and values.contains(m.accumulatorId()):
                    most = max(most, int(values.apply(m.accumulatorId()).replace(",", "")))
    assert 0 < most < 240 * 239 / 4
    assert sum(tables["heads"]) <= 260
