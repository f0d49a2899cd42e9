import hashlib
import random
from collections import Counter

import public_tokenizers
import pytest
import sentencepiece
import tokenizers
from pyspark.sql import functions as F

from loadledger.llm import QUERIES, crosstok
from loadledger.llm.crosstok import alignment, token_groups

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
NAMES = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


@pytest.fixture(scope="module")
def libraries():
    ours = tokenizers.Tokenizer.from_file(A)
    ours.encode_special_tokens = True
    return ours, sentencepiece.SentencePieceProcessor(model_file=B)


def symbols():
    prints = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in prints]
    return {chr(b): b for b in prints} | {chr(256 + k): b for k, b in enumerate(rest)}


def groups_of(text, libraries):
    ours, theirs = libraries
    if not text:
        return []
    whole, byte = (" " + text).encode(), symbols()
    a = [(i, bytes(byte[c] for c in ours.id_to_token(i))) for i in ours.encode(" " + text, add_special_tokens=False).ids]
    b = [(i, bytes([int(theirs.id_to_piece(i)[3:5], 16)]) if theirs.is_byte(i)
          else theirs.id_to_piece(i).replace("▁", " ").encode()) for i in theirs.encode(text)]
    if any(b"".join(t for _, t in side) != whole for side in (a, b)):
        return []
    groups, at_a, at_b, x, y = [([], [])], 0, 0, 0, 0
    while x < len(a) or y < len(b):
        if at_a <= at_b and x < len(a):
            groups[-1][0].append(a[x][0])
            at_a += len(a[x][1])
            x += 1
        else:
            groups[-1][1].append(b[y][0])
            at_b += len(b[y][1])
            y += 1
        if at_a == at_b and at_a < len(whole):
            groups.append(([], []))
    return groups


def brute(rows, libraries):
    made = [(i, groups_of(t, libraries)) for i, t in rows]
    links = [Counter((a, b) for g in groups for a in g[0] for b in g[1]) for _, groups in made]
    counts = Counter(pair for link in links for pair in link)
    most = Counter()
    for (a, _), n in counts.items():
        most[a] = max(most[a], n)
    out = []
    for (i, groups), link in zip(made, links):
        line = ";".join(f"{','.join(map(str, a))}|{','.join(map(str, b))}" for a, b in groups)
        out.append((i, sum(len(a) for a, _ in groups), sum(len(b) for _, b in groups), len(groups), sum(link.values()),
                    sum(n for (a, b), n in link.items() if counts[a, b] == most[a]),
                    sum(n * counts[p] for p, n in link.items()), hashlib.sha256(line.encode()).hexdigest() if line else ""))
    return sorted(out, key=repr)


def got(frame):
    return sorted(((r.doc_id, *[r[name] for name in NAMES]) for r in frame.collect()), key=repr)


def test_given_tables_agree_with_brute_force(spark, sf_dir, libraries):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    assert got(QUERIES["op12_cross_tokenizer_alignment"](spark, sf_dir)) == brute(rows, libraries)


def hard():
    random.seed(6)
    odd = ["a", "the", " ", "  ", "\n", "\t", "'s", "é", "日本語", "😀", "<|endoftext|>", "<s>", "▁", "\x00", "ſ", "1", "2345", "--", "aaaa", "\x85", "  "]
    rows = [(i, "".join(random.choices(odd, k=random.randrange(1, 25)))) for i in range(400)]
    return rows + [(400, None), (401, ""), (402, " "), (None, "null id"), (None, "null id"), (7, "again"), (7, "again"),
                   (403, "<unk>"), (404, "ab" * 3000), (405, "a" * 5000), (406, "word " * 30_000)]


def test_hard_rows(spark, libraries, monkeypatch):
    monkeypatch.setattr(crosstok, "TOGETHER", 4000)
    rows = hard()
    docs = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, text string, block int, id string")
    assert got(alignment(docs, A, B)) == brute(rows, libraries)
    assert got(alignment(docs.repartition(5), A, B)) == brute(rows, libraries)


def test_large_groups_and_small_memory(spark, libraries, monkeypatch):
    rows = hard()[:60] + [(404, "ab" * 300), (405, "a" * 500)]
    want = brute(rows, libraries)
    monkeypatch.setattr(crosstok, "_LARGE", 0)
    monkeypatch.setattr(crosstok, "REMEMBERED", 3)
    made = crosstok.Aligned([t for _, t in rows], crosstok.ByteSide(A), crosstok.PieceSide(B))
    codes, times = made.links()
    links = Counter()
    for code, n in zip(codes.tolist(), times.tolist()):
        links[code >> 32] += n
    assert sorted((i, links[k]) for k, (i, _) in enumerate(rows)) == sorted((r[0], r[4]) for r in want)
    assert dict(zip([i for i, _ in rows], made.digests())) == {r[0]: r[7] for r in want}


def test_groups_are_given_whole(spark, libraries):
    rows = hard()[:50]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for r in token_groups(docs, A, B).collect():
        assert [(g.a, g.b) for g in r.groups] == groups_of(rows[r.doc_id][1], libraries)


def test_the_plan_moves_no_text(spark):
    docs = spark.createDataFrame([(1, "some text")], "doc_id long, text string")
    plan = alignment(docs, A, B)._jdf.queryExecution().executedPlan().toString()
    assert "text" not in plan


def test_empty_tables(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert alignment(docs, A, B).collect() == []
    blank = spark.createDataFrame([(1, ""), (2, None)], "doc_id long, text string").withColumn("n_a", F.lit(3))
    assert got(alignment(blank, A, B)) == [(1, 0, 0, 0, 0, 0, 0, ""), (2, 0, 0, 0, 0, 0, 0, "")]


class Fixed:
    """A side that gives out ids it was given."""

    def __init__(self, made):
        self.bytes, self.made = [b" ", b"a", b"b", b""], made

    def encode(self, texts):
        return self.made


@pytest.mark.parametrize("last, by", [([], None), ([3], "doc")])
def test_documents_are_told_apart_by_place_unless_tokens_are_empty(monkeypatch, last, by):
    asked, merge = [], crosstok.pd.merge_asof
    monkeypatch.setattr(crosstok.pd, "merge_asof", lambda *a, **k: asked.append(k.get("by")) or merge(*a, **k))
    made = crosstok.Aligned(["a", "b"], Fixed([[0, 1, *last], [0, 2]]), Fixed([[0, 1], [0, 2]]))
    assert asked == [by, by]
    assert made.figures()["n_groups"].tolist()[len(last):] == [2, 2][len(last):]
    assert made.figures()["n_a"].tolist() == [2 + len(last), 2]


def test_words_recur_between_texts_and_are_encoded_once(libraries):
    texts = ["one two three\nfour two", "two  one", " two", "two ", "\x00 two", "x", "éé two  ", "</s> two <0x41>"]
    for side, whole in ((crosstok.ByteSide(A), lambda t: libraries[0].encode(" " + t, add_special_tokens=False).ids),
                        (crosstok.PieceSide(B), libraries[1].encode)):
        asked, batch = [], side._batch
        side._batch = lambda words: asked.extend(words) or batch(words)
        for some in (texts, texts, texts[:1]):
            assert [ids.tolist() for ids in side.encode(some)] == [whole(t) for t in some]
        assert len(asked) == len(set(asked)) and sum(word.strip() == "two" for word in asked) == 1
    assert side.encode(["a▁b two", ""]) == [None, None]


def test_a_word_that_is_not_given_back_leaves_its_text_to_the_library():
    side = crosstok.PieceSide(B)
    assert side.apart
    lost = side.library.encode("two")[0]
    side.bytes[lost] += b"?"
    assert [ids is None for ids in side.encode(["one", "one two", "three"])] == [False, True, False]


def agrees(words, texts, libraries):
    want = brute(list(enumerate(texts)), libraries)
    made = words.align(texts)
    figures, links = made.figures(), Counter()
    for code, n in zip(*(column.tolist() for column in made.links())):
        links[code >> 32, code % (1 << 32) >> 16, code % (1 << 16)] += n
    got = {(k, *[int(figures[name][k]) for name in NAMES[:4]], digest) for k, digest in enumerate(made.digests())}
    assert got == {(*row[:5], row[7]) for row in want}
    groups = [groups_of(text, libraries) for text in texts]
    assert links == Counter((k, a, b) for k, found in enumerate(groups) for g in found for a in g[0] for b in g[1])


def test_words_recur_between_texts_and_are_aligned_once(monkeypatch, libraries):
    frames, merge = [], crosstok.pd.merge_asof
    monkeypatch.setattr(crosstok.pd, "merge_asof", lambda x, y, **k: frames.append(len(x)) or merge(x, y, **k))
    words = crosstok.Words(crosstok.ByteSide(A), crosstok.PieceSide(B))
    texts = ["alignment of words", "words of alignment " * 50 + "of", None, "", "of words"]
    agrees(words, texts, libraries)
    once = brute([(0, "alignment of words")], libraries)[0]
    assert sum(frames) == once[1] + once[2]
    agrees(words, texts[::-1], libraries)
    assert sum(frames) == once[1] + once[2]


@pytest.mark.parametrize("limit, abreast", [(1 << 18, 32), (1 << 18, 2), (3, 3)])
def test_words_are_cut_where_neither_side_goes_on(monkeypatch, libraries, limit, abreast):
    monkeypatch.setattr(crosstok, "REMEMBERED", limit)
    monkeypatch.setattr(crosstok, "_ABREAST", abreast)
    words = crosstok.Words(crosstok.ByteSide(A), crosstok.PieceSide(B))
    assert words.a.apart and words.b.apart
    random.seed(11)
    odd = [*"ab1.,'-", "s", " ", " ", "  ", "\n", "\n ", "\t", "\r\n", "\x0b", "\x1c", "\x85", "\xa0", " ", "　",
           "​", "é", "д", "日本", "😀", "'ll", "▁", "\x00", "</s>", "<|endoftext|>", "the", " the", "é"]
    for _ in range(4):
        agrees(words, ["".join(random.choices(odd, k=random.randrange(12))) for _ in range(500)], libraries)


def test_a_word_that_is_not_given_back_has_its_texts_aligned_whole(monkeypatch, libraries):
    words = crosstok.Words(crosstok.ByteSide(A), crosstok.PieceSide(B))
    lost = words.b.library.encode("two")[0]
    words.b.bytes[lost] += b"?"
    made = words.align(["one", "one two", "three one"])
    assert made.figures()["n_a"].tolist() == [1, 0, 2]
    assert made.digests()[1] == "" and made.links()[0].max() >> 32 == 2
    assert words.known["two"] == 0 and words.known["one"] != 0
