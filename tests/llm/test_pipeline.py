"""The corpus pipeline against a brute-force version of its stages."""

import zlib
from collections import Counter

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline

from .test_corpus import LOWER, brute_classes

BLANKS = " \t\n\x0b\x0c\r"


def brute_lines(texts):
    """Texts by doc_id without the lines that a smaller doc_id has too."""
    key = lambda line: line.strip(BLANKS).translate(LOWER)
    first, holders = {}, Counter()
    for i in sorted(texts):
        for k in {key(x) for x in texts[i].split("\n")}:
            first.setdefault(k, i)
            holders[k] += 1
    gone = lambda i, k: len(k) >= 10 and holders[k] > 1 and first[k] != i
    return {i: "\n".join(x for x in t.split("\n") if not gone(i, key(x))) for i, t in texts.items()}


def test_stages_against_brute_force(spark, tmp_path):
    rng = np.random.default_rng(12)
    vocabulary = {"en": "the of and that with from house water bread street night under over window".split(), "fr": "le la les que avec dans maison rue nuit eau pain sous vous fenêtre".split()}
    rows, texts = [], {}
    for i in range(120):
        lang = ["en", "fr"][i % 2]
        words = [f"{w}{rng.integers(30)}" if k % 3 else w for k, w in enumerate(rng.choice(vocabulary[lang], rng.integers(5, 90)))]
        text = " ".join(words[:20]) + "\nA footer that all the pages have\n" + " ".join(words[20:])
        if i % 10 == 7:
            text = texts[i - 2]  # an exact copy
        if i % 10 == 9:
            text = texts[i - 2] + " end"  # a near one
        texts[i] = text
        rows.append((i, text, lang, f"s{i % 3}", len(text), f"k{i}"))
    rows += [(500, "qwpx zzkj vvqx kjhg wqpo zxcm vbnq plok " * 4, None, "s0", 0, "x"), (501, None, "en", "s0", 0, "x"), (502, "12 34", "en", "s1", 0, "x")]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, kept_text string").repartition(3).write.parquet(f"{tmp_path}/documents.parquet")

    left = brute_lines(texts)
    ids = sorted(left)
    classes = brute_classes([left[i] for i in ids])
    kept = {i for n, i in enumerate(ids) if classes[n] == n}
    lib = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {r.doc_id for r in got} == kept
    for i in kept:
        own, at = np.array([*lib.encode(left[i], add_special_tokens=False).ids, 1], "<u4"), 0
        for r in sorted((r for r in got if r.doc_id == i), key=lambda r: r.start):
            assert (r.start, r.doc_tokens, r.ids_crc32) == (at, len(own), zlib.crc32(own[at : at + r.length].tobytes()))
            at += r.length
        assert at == len(own)
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, str(tmp_path))
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars", "kept_text"]
    assert all(r.kept_text == f"k{r.doc_id}" and r.n_chars == len(r.text) for r in docs.collect())
