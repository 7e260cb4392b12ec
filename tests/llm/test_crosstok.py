"""Token alignment against whole texts' tokens and their bytes, one link at a time."""

import hashlib
from collections import Counter, defaultdict

import pytest
import sentencepiece
from conftest import SF
from tokenizers import Tokenizer

from graphmill.llm.crosstok import Aligner, align_tokens, aligned_documents, default_piece_path, op12_cross_tokens
from graphmill.llm.tokens import default_path

ODD = [
    "", " ", "\n", "a", " a", "a ", "a  b", "a\nb", "a\n\nb", "\nab c", "it's I'll 's 'S", "x <|endoftext|> y", "<s> </s> <unk> <0x41> a", "é ç d", "日本 語。 12a b1", "a ́b",
    "ǅ ª º x ⅷ ²", "\0a b\0", "tab\there\rnow\x0bx\x0cy", "\x1ca b", "x\n y", "x \ny", "a\u0085b c", "a b c", "ẞß İi ŉ.\nÉa", "😀 😀😀.\n😀 👩‍👩‍👧", "𝔘𝔫𝔦 x", "x▁y", "a ▁ b", "▁",
    "<0xE6><0x97> z", "​ a", "a b c", "don't.\nstop  it\n\n\n  x", "ⴰⴱ ꙮ ﷽ � \U0010ffff",
]


@pytest.fixture(scope="module")
def libraries():
    a = Tokenizer.from_file(default_path())
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=default_piece_path())
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    byte_of = {chr(x): x for x in plain}
    byte_of |= {chr(256 + i): x for i, x in enumerate(x for x in range(256) if x not in plain)}

    def tokens(text):
        """([(id, start, end)] of A, of B), by nothing but ids and decoded bytes."""
        if not text:
            return [], []
        want = (" " + text).encode()
        out = []
        for ids, decode in (
            (a.encode(" " + text, add_special_tokens=False).ids, lambda i: bytes(byte_of[c] for c in a.id_to_token(i))),
            (b.encode(text), lambda i: bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode()),
        ):
            at, spans, joined = 0, [], b""
            for i in ids:
                piece = decode(i)
                spans.append((i, at, at + len(piece)))
                at += len(piece)
                joined += piece
            if joined != want:
                return [], []
            out.append(spans)
        return tuple(out)

    return tokens


def brute(tokens, text):
    """(n_a, n_b, groups' text, Counter of links)."""
    a, b = tokens(text)
    cuts = sorted({e for _, _, e in a} & {e for _, _, e in b})
    groups, last = [], 0
    of_a, of_b = ({e: n for n, (_, _, e) in enumerate(x)} for x in (a, b))
    for c in cuts:
        lists = [x[of.get(last, -1) + 1 : of[c] + 1] for x, of in ((a, of_a), (b, of_b))]
        groups.append("|".join(",".join(str(i) for i, _, _ in x) for x in lists))
        last = c
    links = Counter()
    by_byte = [j for j, (_, t, f) in enumerate(b) for _ in range(t, f)]
    for i, s, e in a:
        links.update((i, b[j][0]) for j in {by_byte[x] for x in range(s, e)})
    return len(a), len(b), ";".join(groups), links


def want_rows(tokens, docs):
    own = [(doc_id, brute(tokens, text)) for doc_id, text in docs]
    count = Counter(p for _, (_, _, _, links) in own for p in links)
    most = defaultdict(int)
    for (i, _), n in count.items():
        most[i] = max(most[i], n)
    rows = []
    for doc_id, (n_a, n_b, groups, links) in own:
        best = sum(n for (i, j), n in links.items() if count[i, j] == most[i])
        rows.append((doc_id, n_a, n_b, groups.count(";") + 1 if groups else 0, links.total(), best, sum(n * count[p] for p, n in links.items()), groups))
    return sorted(rows, key=repr)


def test_odd_texts_equal_brute_force(spark, libraries):
    docs = [(i, t) for i, t in enumerate([*ODD, *ODD[:7], None])]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    got = sorted((tuple(r) for r in align_tokens(spark, df).collect()), key=repr)
    assert got == want_rows(libraries, docs)


def test_units_cut_where_both_tokenizers_do(libraries, sf_docs):
    al = Aligner(default_path(), default_piece_path(), cache_units=2000)
    assert al.cuts
    texts = [r.text or "" for r in sf_docs.limit(120).collect()] + ODD
    for i in range(0, len(texts), 7):
        unit, cut = al.units(texts[i : i + 7])
        for t, j, k in zip(texts[i : i + 7], cut[:-1], cut[1:], strict=True):
            assert "".join(al.groups[u] for u in unit[j:k])[:-1] == brute(libraries, t)[2]


def test_whole_texts_align_the_same(libraries, sf_docs):
    """Without any cut, as for vocabularies that merge over spaces."""
    al = Aligner(default_path(), default_piece_path())
    al.cuts = False
    texts = [r.text or "" for r in sf_docs.limit(60).collect()] + ODD
    unit, cut = al.units(texts)
    for t, j, k in zip(texts, cut[:-1], cut[1:], strict=True):
        assert k - j <= 1 and "".join(al.groups[u] for u in unit[j:k])[:-1] == brute(libraries, t)[2]


def test_coarse_cuts_refined_by_bytes(libraries):
    al = Aligner(default_path(), default_piece_path())
    units = [" 日本語", " 𝔘x", " aé́", " 👩‍👩‍👧", " ꙮꙮ", " plain"]
    found, good = al.align(units)
    assert all(good)
    for u, text in enumerate(units):
        a, b = libraries(text[1:])
        assert found.counts[:2, u].tolist() == [len(a), len(b)] and found.groups[u][:-1] == brute(libraries, text[1:])[2]


def test_trimming_keeps_what_repeats():
    al = Aligner(default_path(), default_piece_path(), cache_units=40)
    first = al.units(["the cat, the dog. the end"])
    said = ["".join(al.groups[u] for u in first[0])]
    for i in range(40):
        al.units([f"word{i} the x{i}y, the"])
    assert len(al.groups) < 60 and " the" in al.known
    unit, _ = al.units(["the cat, the dog. the end"])
    assert ["".join(al.groups[u] for u in unit)] == said


def test_query_equals_brute_force(spark, libraries, sf_docs):
    got = sorted((tuple(r) for r in op12_cross_tokens(spark, SF).collect()), key=repr)
    want = want_rows(libraries, [(r.doc_id, r.text) for r in sf_docs.select("doc_id", "text").collect()])
    assert got == sorted(((*r[:-1], r[-1] and hashlib.sha256(r[-1].encode()).hexdigest()) for r in want), key=repr)


def test_small_chunks_and_caches_change_nothing(spark, sf_docs):
    whole, parts = (aligned_documents(sf_docs.limit(60), chunk_chars=n).where("pairs is null").select("doc_id", "n_links", "groups").collect() for n in (1 << 22, 3000))
    assert sorted(whole) == sorted(parts)


def test_odd_rows(spark, libraries, odd_docs, no_docs, tmp_path):
    small = odd_docs.where("doc_id is null or doc_id not in (9, 12)")
    got = sorted((tuple(r) for r in align_tokens(spark, small).collect()), key=repr)
    assert got == want_rows(libraries, [(r.doc_id, r.text) for r in small.collect()])
    assert align_tokens(spark, no_docs).collect() == []
    long = {r.doc_id: r for r in align_tokens(spark, odd_docs).collect()}
    assert long[9].n_a > 60000 and long[9].n_links >= long[9].n_a and long[12].n_a > 0
    for df, name in ((odd_docs, "a"), (no_docs, "b")):
        df.write.parquet(f"{tmp_path}/{name}/documents.parquet")
        assert op12_cross_tokens(spark, f"{tmp_path}/{name}").count() == df.count()
