"""Alignment against the tokenisers' own libraries and a plain merge."""

import hashlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidewater.llm import tokenalign as ta
from tidewater.llm.queries import QUERIES

ends = st.lists(st.integers(1, 60), unique=True, max_size=40).map(sorted)


@given(ends, ends, st.integers(1, 9))
@settings(max_examples=200, deadline=None)
def test_pieces_find_every_common_end_once(a, b, size):
    a, b = np.array([*a, 99]), np.array([*b, 99])
    pieces = ta.merge_pieces(a, b, size)
    assert all((a1 - a0) + (b1 - b0) <= size + 1 for a0, a1, b0, b1 in pieces)
    ga, gb = ta.group_sizes(a, b, size)
    common = sorted(set(a) & set(b))
    assert a[np.cumsum(ga) - 1].tolist() == common and b[np.cumsum(gb) - 1].tolist() == common


class Plain:
    """Tokens by the two libraries over whole texts, groups and links by plain loops."""

    def __init__(self):
        import sentencepiece as sp
        from tokenizers import Tokenizer
        self.a = Tokenizer.from_file(ta.A_FILE)
        self.a.encode_special_tokens = True
        self.b = sp.SentencePieceProcessor(model_file=ta.B_FILE)
        self.bytes = {i: t for t, i in ta.byte_level_tokens({t: i for t, i in self.a.get_vocab().items() if i < 50256}).items()}

    def tokens(self, text):
        if not text:
            return [], []
        a = [(i, self.bytes[i]) for i in self.a.encode(" " + text, add_special_tokens=False).ids]
        b = [(i, bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode())
             for i in self.b.encode(text) for p in [self.b.id_to_piece(i)]]
        want = (" " + text).encode()
        return (a, b) if b"".join(x for _, x in a) == b"".join(x for _, x in b) == want else ([], [])

    def groups(self, text):
        a, b = self.tokens(text)
        out, ga, gb, na, nb = [], [], [], 0, 0
        a, b = a[::-1], b[::-1]
        while a or b:
            if na <= nb and a:
                i, x = a.pop()
                ga.append(i)
                na += len(x)
            else:
                i, x = b.pop()
                gb.append(i)
                nb += len(x)
            if na == nb:
                out.append((ga, gb))
                ga, gb = [], []
        return out

    def report(self, rows):
        groups = [self.groups(t) for _, t in rows]
        links = [Counter((a, b) for ga, gb in g for a in ga for b in gb) for g in groups]
        count = Counter(p for x in links for p in x)
        best = defaultdict(int)
        for (a, _), n in count.items():
            best[a] = max(best[a], n)
        out = []
        for (i, _), g, x in zip(rows, groups, links):
            text = ";".join(",".join(map(str, ga)) + "|" + ",".join(map(str, gb)) for ga, gb in g)
            digest = hashlib.sha256(text.encode()).hexdigest() if text else ""
            out.append((i, sum(len(ga) for ga, _ in g), sum(len(gb) for _, gb in g), len(g), sum(x.values()),
                        sum(n for p, n in x.items() if count[p] == best[p[0]]), sum(n * count[p] for p, n in x.items()), digest))
        return out


@pytest.fixture(scope="module")
def plain():
    return Plain()


ROWS = [(1, "Hello world, it's  two  spaces\tand\n\nlines \n"), (2, ""), (3, None), (4, "été naïve 東京 \U0001f600 Ωmega"), (5, "a▁b"),
        (6, "<s> </s> <|endoftext|> <unk> <0x41>"), (None, "no id"), (8, " lead"), (8, " lead"), (9, "trail "), (10, " "), (11, "   "),
        (12, "x" * 3000), (13, "0123456789" * 50), (14, " nbsp em 　 wide"), (15, "\x00\x07 nul"), (16, "ﬁ ① é")]


def _report(df):
    return sorted(((r.doc_id, r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256) for r in df.collect()), key=repr)


def test_report_is_that_of_a_plain_merge(spark, docs_of, plain):
    got = _report(ta.alignment_report(docs_of(ROWS)))
    assert got == sorted(plain.report(ROWS), key=repr)
    assert any(r[1] for r in got) and {r[0] for r in got if r[1] == 0} == {2, 3, 5}


def test_aligned_groups_are_those_of_a_plain_merge(spark, docs_of, plain):
    want = Counter((i, ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in plain.groups(t))) for i, t in ROWS)
    got = ta.align_table(docs_of(ROWS)).collect()
    assert Counter((r.doc_id, r.groups) for r in got) == want
    for r in got:
        assert (sum(r.ga), sum(r.gb), len(r.ga)) == (len(r.a), len(r.b), len(r.gb))


def test_slices_do_not_change_the_report(spark, docs_of, plain, monkeypatch):
    monkeypatch.setattr(ta, "SLICE_ROWS", 3)
    monkeypatch.setattr(ta, "LINKS_AT_ONCE", 7)
    monkeypatch.setattr(ta, "PIECE_ENDS", 5)
    rows = ROWS + [(20 + i, "the same passage, over and over") for i in range(10)]
    assert _report(ta.alignment_report(docs_of(rows).repartition(3))) == sorted(plain.report(rows), key=repr)


def test_real_texts(spark, docs_of, plain):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").where("doc_id < 60").collect()]
    assert _report(ta.alignment_report(docs_of(docs))) == sorted(plain.report(docs), key=repr)


def test_words_of_any_spaced_text_join_to_its_tokens(plain):
    coder = ta.Coder(ta.read_tokenizers())
    for text in [t for _, t in ROWS if t] + ["a  b", "a b  ", "x \n y", "1 2 'll 's . .", "é è \u0085 z", "tab \t tab"]:
        a, n_a, b, n_b = coder.encode([text])
        want = [[i for i, _ in side] for side in plain.tokens(text)]
        assert [a.tolist(), b.tolist()] == want, text


def test_a_group_of_many_tokens_is_counted_before_it_is_crossed():
    n = 3000
    held = {"a": np.zeros(n, dtype=np.int32), "b": np.arange(n, dtype=np.int32) % 2, "ga": np.array([n]), "gb": np.array([n]),
            "n_a": np.array([n]), "n_b": np.array([n]), "n_groups": np.array([1])}
    text, pair, links = ta.document_pairs(held)
    assert pair.tolist() == [0, 1] and links.tolist() == [n * n // 2] * 2


def test_empty_table_clashing_columns_and_digest(spark, docs_of):
    docs = docs_of(ROWS[:4]).withColumn("slice", F.lit("x")).withColumn("a", F.lit(0)).withColumn("groups", F.lit(""))
    assert ta.alignment_report(docs).count() == 4
    assert ta.alignment_report(docs.limit(0)).collect() == []
    got = {r.doc_id: r for r in QUERIES["op11_token_alignment"][0](spark, "/root/testdata/sf0.001").collect()}
    some = next(r for r in got.values() if r.n_a)
    assert len(some.groups_sha256) == 64 and hashlib.sha256(b"").hexdigest() not in {r.groups_sha256 for r in got.values()}
