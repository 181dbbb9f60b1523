import hashlib
import re
import time

import pytest

from leadframe.llm import pii
from leadframe.llm.pii import find, reliabilities

PLAIN = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)",
         "card": r"[0-9](?:[\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def passes(kind, found):
    digits = re.sub("[^0-9]", "", found)
    if kind == "ip":
        return all(int(p) <= 255 for p in found.split("."))
    if kind == "card":
        doubled = [int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(reversed(digits))]
        return 16 <= len(digits) <= 19 and sum(doubled) % 10 == 0
    return kind == "email" or 8 <= len(digits) <= 15


def base(text):
    return [f"{k}:{m.start()}:{m.end()}" for k, p in PLAIN.items() for m in re.finditer(p, text) if passes(k, m[0])]


def agree(rows, texts):
    assert len(rows) == len(texts)
    for r in rows:
        own = base(texts[r.doc_id] or "")
        assert r.base_sha256 == hashlib.sha256(",".join(own).encode()).hexdigest(), (own, texts[r.doc_id])
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(s.startswith(k) for s in own) for k in PLAIN]
        listed = r.spans.split(",") if r.spans else []
        assert set(own) <= set(listed)
        places = [(pii.KINDS.index(s.split(":")[0]), int(s.split(":")[1])) for s in listed]
        assert places == sorted(places)


def test_given_documents(documents, texts):
    agree(find(documents).collect(), texts)


HARD = ["a@b.com_x@y.org z", "a@b@c.com", "a@b.", "x@y.z.", "@@a@b.c@d.e", "1.2.3.4.5.6.7.8", "1.2.3.999 0001.2.3.0255", "256.1.1.1.1",
        "4111 1111 1111 1111", "4111-1111-1111-1111 4111111111111112", "4 1 1 1 1 1 1 1 1 1 1 1 1 1 1 1 4111 1111 1111 1111", "--1-", "+1 (743) 555-3824.",
        "+1 2", "+12345678", "++49 30 1234567 +", "+1 234 567 8901 234 567 89", "\U0001f600 é a@b.de \U0001f600 +49 (30) 123-4567", "é" * 9 + "10.0.0.1",
        "a" * 30_000, "1." * 20_000, "a@b" + ".c" * 20_000, "1 " * 20_000, "+1" + " " * 20_000, "+1" * 9_000, "a@" * 20_000, "", None, "..@..", "%+-@-.-"]


def test_hard_texts(spark):
    docs = spark.createDataFrame([(i, t, 1, "k") for i, t in enumerate(HARD)], "doc_id bigint, text string, kind int, spans string").repartition(4)
    began = time.time()
    agree(find(docs).collect(), dict(enumerate(HARD)))
    assert time.time() - began < 60


def test_added_spans(spark):
    certain = [f"mail me: u{i}@host.com or phone +1 (743) 555-{1000 + i}, server 10.0.0.{i}, card 4111 1111 1111 1111." for i in range(40)]
    loose = "phone (743) 555-3824, e-mail joe [at] site [dot] org, card 4111.1111.1111.1111 and host 8[.]8[.]4[.]4 too"
    clean = "order 12 of 1999, chapter 3.2.1, invoice 200-300-400x and at home (at) noon"
    docs = spark.createDataFrame(list(enumerate(certain + [loose, clean])), "doc_id bigint, text string")
    rows = {r.doc_id: r.spans for r in find(docs).collect()}
    assert all(rows[i] == ",".join(base(certain[i])) for i in range(40))
    found = [loose[int(s.split(":")[1]):int(s.split(":")[2])] for s in rows[40].split(",")]
    assert found == ["joe [at] site [dot] org", "8[.]8[.]4[.]4", "4111.1111.1111.1111", "(743) 555-3824"]
    assert rows[41] == ""


def test_reliabilities_follow_agreement():
    yes, no = 3 ** 5 - 1, 0
    right = reliabilities({yes: 900, no: 100})
    assert right[yes] > 0.99 and right[no] < 0.01
    # a labeler that says yes to everything comes to mean little
    always = [p + 2 - p % 3 for p in (yes, no)]
    right = reliabilities({always[0]: 500, always[1]: 500})
    assert right[always[1]] < 0.05
    assert 0 < reliabilities({})[121] < 1


@pytest.mark.parametrize("n", [0, 1])
def test_odd_rows(odd, empty, n):
    docs = (odd, empty)[n]
    rows = find(docs).collect()
    assert len(rows) == docs.count()
    assert all(r.spans == "" or r.doc_id == 8 for r in rows)


def test_precision_and_recall_of_added_spans(spark):
    """Loose spellings among look-alikes, 70 % of both behind a cue word: recall 0.94, precision 0.76 when written.

    What is wrongly added are numbers in the shape of a telephone number behind no cue or a wrong one.
    """
    import random

    draw = random.Random(9)
    word = lambda: "".join(draw.choices("abcdefghij", k=5))
    digits = lambda n: "".join(draw.choices("0123456789", k=n))

    def card():
        body = "4" + digits(14)
        total = sum(int(c) if i % 2 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(reversed(body)))
        number = body + str(-total % 10)
        return ".".join(number[i:i + 4] for i in range(0, 16, 4))

    real = [lambda: ("email", f"{word()} [at] {word()} [dot] org", "mail "), lambda: ("email", f"{word()}(at){word()}.com", "contact "),
            lambda: ("ip", "[.]".join(str(draw.randrange(1, 255)) for _ in range(4)), "server "), lambda: ("card", card(), "visa "),
            lambda: ("phone", f"({digits(3)}) {draw.randrange(200, 999)}-{digits(4)}", "call ")]
    like = [lambda: ("card", ".".join(digits(4) for _ in range(4)), "order "),
            lambda: ("phone", f"{draw.randrange(100, 999)}-{digits(3)}-{digits(3)}", "invoice "),
            lambda: ("ip", f"{draw.randrange(300, 999)}[.]{draw.randrange(1, 9)}[.]0[.]1", "version ")]
    rows = [(10_000 + i, f"mail {word()}@{word()}.com from ip 10.2.{i % 250}.7 call +49 30 {digits(7)} card 4111 1111 1111 1111") for i in range(200)]
    wanted = set()
    for i in range(600):
        kind, text, cue = draw.choice(real if i % 2 else like)()
        lead = f"{word()} {cue if draw.random() < 0.7 else ''}"
        rows.append((i, f"{lead}{text} {word()}"))
        if i % 2:
            wanted.add((i, f"{kind}:{len(lead)}:{len(lead) + len(text)}"))
    found = {(r.doc_id, s) for r in find(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)).collect()
             for s in r.spans.split(",") if s and r.doc_id < 10_000}
    assert len(found & wanted) >= 0.9 * len(wanted) and len(found & wanted) >= 0.7 * len(found)
