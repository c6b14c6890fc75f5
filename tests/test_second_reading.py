"""The second decoder of mail against the first, and on mail that only it must survive."""

import base64
import email.message
import email.policy

import pytest

from recordloom.sources import mbox, second_reading


def test_charsets_and_transfer_encodings():
    for charset, encoding, text in [("gb18030", "base64", "客户 龘 €"), ("iso-8859-1", "quoted-printable", "Größe = 5 \t\nFrom here"), ("utf-8", "8bit", "naïve — ok"), ("gb2312", "8bit", "订单")]:
        msg = email.message.EmailMessage(policy=email.policy.SMTP if encoding != "8bit" else email.policy.default)
        msg["Subject"], msg["From"], msg["To"] = "Anfrage für 上海", '"Li, Anna" <Anna@X.com>', "b@y.com, Bo <bo@z.com>"
        msg.set_content(text, charset=charset, cte=encoding)
        raw = bytes(msg)
        one, two = mbox.message_row("f", raw), second_reading.message_row("f", raw)
        assert two[9] is None and one[12] is None
        assert two[7].split() == text.split() == one[9].split()
        assert (two[1], two[3], two[4], two[6]) == (one[1], one[3], one[4], one[6])
        assert two[3] == {"name": "Li, Anna", "email": "anna@x.com"}


def test_parts_and_names():
    msg = email.message.EmailMessage()
    msg["Message-ID"], msg["Date"], msg["Subject"] = "<A@x>", "Mon, 18 May 2026 23:30:05 -0230", "plain"
    msg.set_content("text")
    msg.add_alternative("<p>markup</p>", subtype="html")
    msg.add_attachment(b"\x00\x01" * 500, maintype="application", subtype="pdf", filename="报价 2026.pdf")
    raw = bytes(msg)
    one, two = mbox.message_row("f", raw), second_reading.message_row("f", raw)
    assert two[2] == one[2] and two[2].isoformat() == "2026-05-19T02:00:05+00:00"
    assert two[8] == one[10] and two[8][0]["filename"] == "报价 2026.pdf" and two[8][0]["size"] == 1000
    assert two[7].strip() == "text"


def test_encoded_words_may_cut_a_character():
    data = "报价".encode()
    word = lambda b: f"=?utf-8?B?{base64.b64encode(b).decode()}?="
    assert second_reading.spoken(f"{word(data[:4])} {word(data[4:])} end") == "报价 end"
    assert second_reading.spoken("=?iso-8859-1?q?Gr=F6=DFe_1?= =?utf-8?q?=C3=A4?=") == "Größe 1ä"


@pytest.mark.parametrize("raw", [b"", b"\n", b"no header at all", b"Subject: =?x?y", b"Content-Type: multipart/mixed; boundary=b\n\n--b\n--b\n--b", b"To: <<<<((((\"\n\n", b"Date: 99 Foo 2020 99:99\n\n", b"Content-Transfer-Encoding: base64\n\n!!A=", b"\xff\xfe: \xff\n\n\xff"])
def test_broken_mail_is_a_row(raw):
    row = second_reading.message_row("f", raw)
    assert len(row) == 10 and row[9] is None


def test_time_is_linear():
    import time

    began = time.monotonic()
    for raw in (b"To: " + b"<" * 300_000, b"To: " + b'"' * 300_001, b"Subject: " + b"=?" * 300_000, b"Content-Type: a/b" + b'; a="' * 100_000, b"Content-Type: multipart/mixed; boundary=b\n\n" + b"--b\n" * 100_000):
        second_reading.message_row("f", raw + b"\n\nx")
    assert time.monotonic() - began < 20


def test_files_that_the_first_reader_missed(spark, tmp_path):
    head = "From - Mon May 18 10:00:00 2026\nMessage-ID: <{}@x>\n\nbody\n\n"
    (tmp_path / "Inbox").write_text("".join(head.format(k) for k in range(3)))
    (tmp_path / "notes").write_text("nothing of the kind\nFrom here on\n")
    first = mbox.readings(spark, str(tmp_path))
    assert first.count() == 3
    found = {r["file"].rsplit("/", 1)[1]: (r["field"], r["first"], r["second"]) for r in second_reading.files(spark, str(tmp_path), first).collect()}
    assert found == {"notes": ("no_mailbox", 0, 0)}
    fewer = {r["file"].rsplit("/", 1)[1]: r["field"] for r in second_reading.files(spark, str(tmp_path), first.where("message_id <> '1@x'")).collect()}
    assert fewer == {"Inbox": "messages", "notes": "no_mailbox"}
    assert second_reading.disagreements(first, second_reading.readings(spark, str(tmp_path))).count() == 0
    assert second_reading.disagreements(first.limit(0), first.limit(0)).count() == 0
