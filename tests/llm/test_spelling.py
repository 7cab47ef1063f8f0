import collections
import random
import re
import zlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.llm import queries, spelling
from tests.llm.test_pipeline import SF

LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def words_of(rows, least=3, spoil=97):
    """Words and their counts, one run at a time."""
    counts = collections.Counter()
    for i, text in rows:
        for w in re.findall("[A-Za-zÀ-ÿ]+", (text or "").translate(LOWER)):
            h = zlib.crc32(f"{'' if i is None else i}:{w}".encode())
            if spoil and h % spoil == 0:
                k = h % len(w)
                w = w[:k] + w[k + 1:]
            if len(w) >= 5:
                counts[w] += 1
    return {w: n for w, n in counts.items() if n >= least}


def one_edit(a, b):
    """Whether exactly one code point is inserted, deleted or replaced."""
    if len(a) > len(b):
        a, b = b, a
    if a == b or len(b) - len(a) > 1:
        return False
    i = next((i for i in range(len(a)) if a[i] != b[i]), len(a))
    return a[i + 1:] == b[i + 1:] if len(a) == len(b) else a[i:] == b[i + 1:]


def brute_force(known):
    """Rows (word, form, root, n, n_near, form_n), each word against all others of about its length."""
    by_length = collections.defaultdict(list)
    for w in known:
        by_length[len(w)].append(w)
    near = {w: [o for d in (-1, 0, 1) for o in by_length[len(w) + d] if one_edit(w, o)] for w in known}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda o: (-known[o], o), default=None)
        if best is not None and known[best] >= 2 * known[w]:
            form[w] = best
    rows = set()
    for w, n in known.items():
        root = w
        while root in form:
            root = form[root]
        rows.add((w, form.get(w), root, n, len(near[w]), known.get(form.get(w))))
    return rows


def rows_of(df):
    rows = [tuple(r) for r in df.select("word", "form", "root", "n", "n_near", "form_n").collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def test_query_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    want = brute_force(words_of(docs))
    assert len(want) > 1000 and any(r[1] for r in want)
    assert rows_of(queries.op11_spelling(spark, SF)) == want


def made(spark, known):
    return spark.createDataFrame([(i, " ".join([w] * n)) for i, (w, n) in enumerate(known.items())], "doc_id int, text string")


def test_long_lists_meet_by_what_is_left_of_words(spark, monkeypatch):
    """Words over few letters share all their grams; no pair may be lost, however long the lists."""
    rng = random.Random(5)
    known = {"".join(rng.choice("ab") for _ in range(rng.randint(5, 9))): rng.choice([3, 4, 6, 12, 24]) for _ in range(400)}
    monkeypatch.setattr(spelling, "COMMON", 4)
    for size in (2, 64, 10 ** 6):
        monkeypatch.setattr(spelling, "LIST", size)
        assert rows_of(spelling.spelling_variants(made(spark, known), spoil=0)) == brute_force(known)


def test_defined_cases(spark):
    docs = spark.createDataFrame(
        [(1, "House house HOUSE, housé housé housé", "x"), (1, "house house house", "x"), (2, None, "x"), (3, "", "x"),
         (None, "mouse mouse mouse horse horse horse", "x"), (4, "four four four", "x"), (5, "word" * 40_000 + " " + "z" * 5, "x"),
         (6, "Äpfel Äpfel Äpfel äpfel äpfel äpfel äpfel äpfel äpfel", "x")],
        "doc_id int, text string, word string")
    got = rows_of(spelling.spelling_variants(docs, spoil=0))
    assert got == {("house", None, "house", 6, 3, None), ("housé", "house", "house", 3, 1, 6), ("mouse", "house", "house", 3, 1, 6),
                   ("horse", "house", "house", 3, 1, 6), ("Äpfel", "äpfel", "äpfel", 3, 1, 6),
                   ("äpfel", None, "äpfel", 6, 1, None)}
    assert rows_of(spelling.spelling_variants(docs)) == brute_force(words_of([(r["doc_id"], r["text"]) for r in docs.collect()]))
    assert rows_of(spelling.spelling_variants(docs.where("false"))) == set()
    with pytest.raises(ValueError, match="five characters"):
        spelling.spelling_variants(docs, shortest=4)


def test_forms_are_followed_and_ties_go_to_the_smaller_word(spark):
    known = {"aaaaaa": 48, "aaaaab": 24, "aaaabb": 12, "aaabbb": 6, "aabbbb": 3, "zzzzz": 3, "zzzzy": 6, "zzzzx": 6}
    got = {r[0]: r for r in rows_of(spelling.spelling_variants(made(spark, known), spoil=0))}
    assert [got[w][2] for w in ("aabbbb", "aaabbb", "aaaaab", "aaaaaa")] == ["aaaaaa"] * 4
    assert got["zzzzz"][1] == "zzzzx"


letters = st.text("abc", min_size=5, max_size=9)


@settings(max_examples=300, deadline=None)
@given(letters, st.integers(0, 9), st.sampled_from("abcd"), st.sampled_from("ird"),
       st.sets(st.text("\x02abc\x03", min_size=2, max_size=4), max_size=40))
def test_words_one_edit_apart_share_a_list(word, at, letter, edit, grams):
    """Whatever grams are common, and however often: the bound on affected grams loses no pair."""
    common = {g: 100 + 7 * (zlib.crc32(g.encode()) % 5) for g in grams}
    at = min(at, len(word) - (edit != "i"))
    other = word[:at] + letter + word[at:] if edit == "i" else word[:at] + (letter if edit == "r" else "") + word[at + 1:]
    if len(other) < 5:
        return
    assert set(spelling.listed(word, common)) & set(spelling.listed(other, common))
