import random
import re
from collections import Counter

from graphmill.llm.substring import MAX_WORDS, MIN_SPAN_WORDS, MIN_WORDS, SPAN, dedup_substrings

from .conftest import words


def sentences(text):
    """[(start, end, words)] of character positions, one word at a time."""
    out, prev_end = [], None
    for m in re.finditer(r"[^\x20\x09-\x0D]+", text):
        tail = m.group().rstrip("\"')]}") if len(m.group()) > 1 else m.group()
        new = prev_end is None or ended or "\n" in text[prev_end : m.start()] or n == MAX_WORDS  # noqa: F821
        if new and prev_end is not None and not (ended or "\n" in text[prev_end : m.start()]):  # noqa: F821
            pass
        if new:
            out.append([m.start(), m.end(), [m.group()]])
            n = 0
        else:
            out[-1][1] = m.end()
            out[-1][2].append(m.group())
        n += 1
        prev_end, ended = m.end(), tail[-1:] in (".", "!", "?")
    return out


def brute(rows):
    """rows: (order, text); the cleaned texts."""
    split = [sentences(t or "") for _, t in rows]
    first = {}
    runs = []
    for (order, _), s in zip(rows, split, strict=True):
        for i in range(len(s) - SPAN + 1):
            key = tuple(tuple(words(" ".join(x[2]))) for x in s[i : i + SPAN])
            if sum(map(len, key)) >= MIN_SPAN_WORDS:
                runs.append((order, i, key))
                first[key] = min(first.get(key, order), order)
    marked = {order: set() for order, _ in rows}
    met = set()
    for order, i, key in sorted(runs, key=lambda r: (r[0], r[1])):
        if order > first[key] or (order, key) in met:
            marked[order].update(range(i, i + SPAN))
        met.add((order, key))
    out = []
    for (order, t), s in zip(rows, split, strict=True):
        keep, at, i = [], 0, 0
        while i < len(s):
            j = i
            while j < len(s) and j in marked[order]:
                j += 1
            if j > i and sum(len(x[2]) for x in s[i:j]) >= MIN_WORDS:
                keep.append(t[at : s[i][0]])
                at = s[j][0] if j < len(s) else len(t)
            i = max(j, i + 1)
        out.append(None if t is None else "".join(keep) + t[at:])
    return out


def check(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.text for r in dedup_substrings(spark, docs).collect()}
    assert got == {i: t for (i, _), t in zip(rows, brute(rows), strict=True)}
    return got


def test_passages_between_other_texts(spark):
    rng = random.Random(3)
    word = lambda: f"w{rng.randrange(5000)}"
    sentence = lambda n: " ".join(word() for _ in range(n)).capitalize() + rng.choice([".", "!", "?", '."'])
    text = lambda n: rng.choice([" ", "\n", "  \n"]).join(sentence(rng.randrange(1, 30)) for _ in range(n))
    passages = [text(rng.randrange(3, 9)) for _ in range(4)]
    rows = []
    for i in range(40):
        middle = rng.choice([*passages, text(2)])
        rows.append((i, f"{text(rng.randrange(0, 4))}\n{middle}\n{text(rng.randrange(0, 4))}"))
    got = check(spark, rows)
    long = [p for p in passages if len(words(p)) > 50]
    assert long
    for p in long:
        assert sum(p in t for t in got.values()) <= 1


def test_tables(spark, sf_docs):
    check(spark, [(r.doc_id, r.text) for r in sf_docs.collect()])


def test_repeats_inside_one_text(spark):
    line = "Alpha beta gamma delta. One two three. Four five six seven eight nine ten eleven."
    got = check(spark, [(1, "\n".join([line] * 6)), (2, "short"), (3, "")])
    assert got[1].count("Alpha") == 1


def test_odd_rows(spark, odd_docs, no_docs):
    got = dedup_substrings(spark, odd_docs).collect()
    assert Counter(r.doc_id for r in got) == Counter(r.doc_id for r in odd_docs.collect())
    by = {r.doc_id: r for r in got}
    assert by[4].text is None and by[5].text == "" and by[7].text == " \t\n "
    assert by[1].n_removed == 0 and by[2].text == "" and by[3].n_removed > 0
    assert dedup_substrings(spark, no_docs).count() == 0


def test_copies_made_of_very_short_sentences(spark):
    """Lists, verse and junk of one-word sentences or lines: three of them are fewer words than any floor."""
    rng = random.Random(5)
    junk = lambda end: end.join(f"w{rng.randrange(5000)}" for _ in range(170))
    copies = [junk("\n"), junk(".!! "), junk("? ")]
    rows = [(i, c) for i, c in enumerate(copies)] + [(10 + i, f"Own words here {i}.\n{c}\nLast words of {i}.") for i, c in enumerate(copies)]
    got = check(spark, rows)
    assert [got[i] for i in range(3)] == copies
    assert [got[10 + i] for i in range(3)] == [f"Own words here {i}.\nLast words of {i}." for i in range(3)]


def test_short_repeats_go_too(spark):
    passage = "Alpha beta gamma delta. One two three. Four five six seven."
    rows = [(1, f"The first text. {passage}"), (2, f"Another text here. {passage} Its own end.")]
    assert check(spark, rows)[2] == "Another text here. Its own end."
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.doc_id: r.text for r in dedup_substrings(spark, docs, min_words=12).collect()} == dict(rows)


def repeated_windows(rows, n):
    """Of each text, the runs of ``n`` words that an earlier text has."""
    seen, out = set(), {}
    for i, text in sorted(rows):
        w = words(text)
        own = {tuple(w[k : k + n]) for k in range(len(w) - n + 1)}
        out[i] = own & seen
        seen |= own
    return out


def test_passages_inside_longer_sentences(spark):
    rng = random.Random(8)
    some = lambda n: [f"w{rng.randrange(50000)}" for _ in range(n)]
    rows, kept = [], {}
    for at in range(12):
        for n in (51, 52, 57, 64, 80, 100):
            passage = some(n)
            if at % 3 == 0:
                passage[n // 3] += "."
            i = len(rows)
            for lead in (0, at) if at else (5, 5):
                own, end = some(lead), some(30)
                kept[len(rows)] = (own, end)
                rows.append((len(rows), " ".join([*some(20), "end.", *own, *passage, *end]) + "."))
            assert repeated_windows(rows[i:], 51)[i + 1]
    # one word edited before the passage
    long = some(90)
    rows += [(1000, " ".join(long)), (1001, " ".join([*long[:7], "edited", *long[8:]]))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r for r in dedup_substrings(spark, docs, anywhere=True).collect()}
    for i, text in rows:
        if i % 2 == 0:
            assert got[i].text == text
        else:
            w = got[i].text.split()
            assert not repeated_windows([(0, dict(rows)[i - 1]), (1, got[i].text)], 30)[1]  # at most the passage's ends stay
            assert got[i].words_removed == len(text.split()) - len(w) and 0 < got[i].n_removed < got[i].n_sentences
            if i in kept:  # and nothing else goes
                assert " ".join(kept[i][1]) in got[i].text and " ".join(kept[i][0]) in got[i].text


def test_query_leaves_no_repeated_window(spark):
    """A plain scan of all runs of 51 words of the test documents: no text keeps one that an earlier one has."""
    from graphmill.llm.substring import op2_substring_dedup

    rows = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()]
    got = {r.doc_id: words(r.text) for r in op2_substring_dedup(spark, "/root/testdata/sf0.01").collect()}
    found = {i: w for i, w in repeated_windows(rows, 51).items() if w}
    assert found
    for i, windows in found.items():
        assert not windows & {tuple(got[i][k : k + 51]) for k in range(len(got[i]) - 50)}
