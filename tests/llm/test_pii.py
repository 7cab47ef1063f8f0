import random
import re

from tidemark.llm import pii

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(d):
    return sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(reversed(d))) % 10 == 0


def brute(t):
    digits = lambda s: re.sub("[^0-9]", "", s)
    out = [("email", *m.span()) for m in EMAIL.finditer(t)]
    out += [("ip", *m.span()) for m in IP.finditer(t) if all(int(p) <= 255 for p in m.group().split("."))]
    out += [("card", *m.span()) for m in CARD.finditer(t) if 14 <= len(digits(m.group())) <= 19 and luhn(digits(m.group()))]
    out += [("phone", *m.span()) for m in PHONE.finditer(t) if 10 <= len(digits(m.group())) <= 15]
    return sorted(out, key=lambda x: (x[1], pii.BASE_KINDS.index(x[0])))


def texts():
    r = random.Random(6)
    out = ["a@b.c", "a@@b.c", "a@b", "x.a@b.c@d.e", "é@b.c", "a@b..c", "1.2.3.4", "1.2.3.4.5.6.7.8", "1.2.3.256", "01.002.0003.4",
           "4111 1111 1111 1111", "4111-1111-1111-1111 2", "4111111111111112", "+1 (555) 123-4567", "+44.20.7946.0958)",
           "++49 30 1234567", "a" * 300 + "@b.c", "@".join("abc"), "1" * 400]
    pieces = ["4111 1111 1111 1111", "10.0.0.1", "+1 555 123 4567", "me@x.org", "@", ".", "-", " ", "+", "7", "12", "a", "é", "(", ")"]
    out += ["".join(r.choice(pieces) for _ in range(r.randint(1, 14))) for _ in range(3000)]
    return out


def test_base_spans_equal_the_definitions():
    for t in texts():
        got = sorted(pii.base_spans(t), key=lambda x: (x[1], pii.BASE_KINDS.index(x[0])))
        assert got == brute(t), repr(t)


def planted(spark):
    r = random.Random(8)
    rows = []
    for i in range(400):
        number = f"{r.randint(200, 899)}-{r.randint(200, 999)}-{r.randint(1000, 9999)}"
        key = "".join(r.choice("abcdef0123456789") for _ in range(40))
        rows.append((i, [f"call {number} today", f"secret token={key} here", f"mail me{i}@site.com now", "nothing here at all",
                         f"Dear Mr. Peter Miller{'x' * (i % 3)}, hello"][i % 5], "extra", 3))
    rows += [(1000, None, "extra", None), (1001, "", None, 0), (3, "nothing here at all", "extra", 3)]
    return spark.createDataFrame(rows, "doc_id int, text string, kind string, n_chars long"), rows


def test_base_stays_and_added_spans_keep_clear_of_it(spark):
    docs, rows = planted(spark)
    model = pii.train(docs)
    got = pii.find_spans(docs, model).collect()
    assert len(got) == len(rows) and got[0].asDict().keys() == {"doc_id", "text", "kind", "n_chars", "spans"}
    kinds = set()
    for r in got:
        base = [(s["kind"], s["start"], s["end"]) for s in r["spans"] if s["base"]]
        assert base == brute(r["text"] or "")
        for s in r["spans"]:
            kinds.add(s["kind"])
            if not s["base"]:
                assert all(s["end"] <= a or s["start"] >= b for _, a, b in base)
    assert {"email", "local_phone", "secret"} <= kinds
    assert all(not r["spans"] for r in got if r["text"] in (None, "", "nothing here at all"))


def test_redacted_texts_hold_none_of_it(spark):
    docs, rows = planted(spark)
    out = pii.redact(docs, pii.train(docs)).collect()
    assert len(out) == len(rows)
    for r in out:
        assert brute(r["text"] or "") == []
        assert r["text"] is None or r["n_chars"] == len(r["text"])
    plain = {r["doc_id"]: r["text"] for r in out}
    assert plain[1000] is None and plain[1001] == "" and plain[3] == "nothing here at all" and plain[2] == "mail [EMAIL] now"


def test_no_candidates_and_no_rows(spark):
    docs = spark.createDataFrame([(1, "plain words")], "doc_id int, text string")
    for d in (docs, docs.where("false")):
        assert all(r["spans"] == [] for r in pii.find_spans(d, pii.train(d)).collect())
