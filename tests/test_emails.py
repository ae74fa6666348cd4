import email
import random
from email.mime.message import MIMEMessage
from email.mime.multipart import MIMEMultipart
from email.mime.text import MIMEText

import pytest
from pyspark.sql import functions as F

from opinara.operators.emails import ORIGINAL_NAMES, message_parts, parse_emails, split_readable

MESSAGES = [
    "From: a@x\nTo: b@y\nSubject: hi\nDate: Mon, 1 Jan 2024\n\nbody\nmore\n",
    "from: a@x\r\nTO: b@y\r\nsubject: hi\r\n there\r\n\r\nbody\r\n\r\nmore",
    "Subject: first\nSubject: second\n\nx",
    "Subject:\nTo:   \n\n",
    "Subject: =?utf-8?q?caf=C3=A9?=\n =?utf-8?q?x?=\nContent-Transfer-Encoding: base64\n\naGVsbG8=\n",
    "no header at all\nsecond line",
    "",
    "\nbody only",
    "Subject: no body",
    "Subject: no blank line\nthis is body\nFrom: inside\n",
    "From someone Mon Jan 1\nSubject: unix from\n\nx",
    "Subject: a b\u0085c\nTo: 😀 x\n\n😀 body   line",
    " continuation first\nSubject: s\n\nb",
    "Subject: old mac\rTo: t\r\rbody\rmore",
    "X: 1\nTo: " + ",\n ".join(f"p{i}@example.com" for i in range(3000)) + "\n\nlong header",
    "\n".join(f"H{i}: v" for i in range(5000)) + "\nSubject: last\n\nmany headers",
    "Subject: x\n\n" + "line\n" * 20000,
    "Sub ject: no\nTo: t\n\nb",
    "Subject : no\nTo: t\n\nb",
    "To: a\n\t tab fold\n\nb",
    "Date:no space\nSubject::colon\n\nb",
]


def standard(text):
    m = email.message_from_string(text)
    return tuple(m.get(n) for n in ("From", "To", "Subject", "Date")) + (m.get_payload(),)


def parse(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, message string")
    rows = parse_emails(df).orderBy("i").collect()
    return [tuple(r[c] for c in ("sender", "recipient", "subject", "date", "body")) for r in rows]


def test_same_as_the_standard_parser(spark):
    for text, found in zip(MESSAGES, parse(spark, MESSAGES)):
        assert found == standard(text), text[:80]


def test_random_messages(spark):
    rng = random.Random(5)
    lines = ["Subject: a", "subject:b", "To: c ", " fold", "\tfold", "", "text", "X-Y: z", "From: q", "From x y", "Date:", ":bad", "é: x", ":", "a b: c"]
    texts = ["".join(rng.choice(lines) + rng.choice(["\n", "\r\n", "\r"]) for _ in range(rng.randint(0, 9)))
             + rng.choice(["", "end", "Subject: end", "From z"]) for _ in range(3000)]
    for text, found in zip(texts, parse(spark, texts)):
        assert found == standard(text), repr(text)


def test_multipart_keeps_the_raw_text(spark):
    text = "Content-Type: multipart/mixed; boundary=q\nTo: t\n\n--q\n\npart\n--q--\n"
    row = parse_emails(spark.createDataFrame([(text,)], "message string")).first()
    assert row["is_multipart"] and row["body"] == "--q\n\npart\n--q--\n"


def test_original_names(spark):
    df = parse_emails(spark.createDataFrame([("To: t\n\nb",)], "message string"), original_names=True)
    assert df.columns == [*ORIGINAL_NAMES.values(), "is_multipart"]


def test_unreadable_files_are_set_apart(spark):
    rows = [("a", b"To: t\n\nok"), ("b", b"\xff\xfe"), ("c", None), ("d", "é".encode()), ("e", "é".encode("latin-1"))]
    good, bad = split_readable(spark.createDataFrame(rows, "name string, content binary"))
    assert sorted(r["name"] for r in good.collect()) == ["a", "d"]
    assert sorted(r["name"] for r in bad.collect()) == ["b", "c", "e"]


def grown(rng, depth, path, rows):
    """A random tree of parts and, in ``rows``, what has to be found in it."""
    whole = MIMEMultipart(rng.choice(["mixed", "alternative", "related"]))
    for number in range(1, rng.randint(2, 4)):
        place = f"{path}{number}"
        if depth and rng.random() < 0.4:
            at = len(rows)
            inner = grown(rng, depth - 1, f"{place}.", rows)
            rows.insert(at, (place, inner.get_content_type(), None, None))
        elif rng.random() < 0.2:
            inner = MIMEMessage(MIMEText("inside " * rng.randint(0, 3)))
            rows += [(place, "message/rfc822", None, None), (f"{place}.1", "text/plain", None, inner.get_payload()[0].get_payload())]
        else:
            text = rng.choice(["", "one line", "two\nlines\n", "--not a boundary\n\nx", "From here\n" * 400])
            inner, name = MIMEText(text, rng.choice(["plain", "html"])), rng.choice([None, f"file {number}.txt"])
            if name:
                inner.add_header("Content-Disposition", "attachment", filename=name)
            rows.append((place, inner.get_content_type(), name, text))
        whole.attach(inner)
    return whole


def test_parts_of_generated_mail(spark):
    rng, texts, want = random.Random(11), [], []
    for n in range(150):
        rows = []
        whole = grown(rng, 3, "", rows)
        whole["Subject"] = f"mail {n}"
        text = whole.as_string()
        texts.append(text.replace("\n", "\r\n") if n % 3 == 0 else text)
        want.append([(*r[:3], r[3].replace("\n", "\r\n") if n % 3 == 0 and r[3] else r[3]) for r in rows])
    df = spark.createDataFrame(list(enumerate(texts)), "i int, message string").repartition(4)
    found = [[tuple(p) for p in r["parts"]] for r in message_parts(df).orderBy("i").collect()]
    assert found == want


def test_messages_without_parts(spark):
    texts = [None, "", "Subject: x\n\nbody", "Content-Type: multipart/mixed; boundary=q\n\nno boundary here",
             "Content-Type: multipart/mixed\n\n--q\n\nx\n--q--\n", "Content-Type: multipart/mixed; boundary=q\n\n--q\n\ncut off"]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, message string")
    found = [r["parts"] for r in message_parts(df).orderBy("i").collect()]
    assert found[0] is None and found[1:5] == [[], [], [], []]
    assert [tuple(p) for p in found[5]] == [("1", "text/plain", None, "cut off")]
    assert message_parts(df.limit(0)).collect() == []
