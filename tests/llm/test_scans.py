"""Secret and license scans."""

from __future__ import annotations

import base64
import json
import struct

import plain
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from basketry.llm import licenses, secrets
from basketry.llm.license_rules import rules
from basketry.llm.licenses import Detection, suppressed

BITS = ["token", "secret=", "API_KEY", "apikey", "password", '"', "'", " ", ":", "=", "abcdef012345", "AKIA", "ABCDEFGH1234567", "deadbeefcafe", "ſecret", "-", "é", "\n"]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(BITS), max_size=14).map("".join))
def test_base_spans_equal_the_plain_patterns(text):
    counts, spans = plain.secret(text)
    got = secrets._report(text)
    assert list(got[:3]) == counts and got[3] == plain.sha(spans)


def der(tag: int, body: bytes) -> bytes:
    n = len(body)
    return bytes([tag]) + (bytes([n]) if n < 128 else bytes([0x82]) + n.to_bytes(2, "big")) + body


NUMBER = der(0x02, b"\x11" * 64)
PRIVATE = der(0x30, der(0x02, b"\0") + NUMBER * 8)
PUBLIC = der(0x30, der(0x30, der(0x06, b"\x2a\x86\x48") + der(0x05, b"")) + der(0x03, b"\0" + NUMBER))
WIRE = b"".join(struct.pack(">I", len(f)) + f for f in (b"ssh-ed25519", b"\x07" * 32))
OPENSSH = b"openssh-key-v1\0" + b"".join(struct.pack(">I", len(f)) + f for f in (b"none", b"none", b"")) + struct.pack(">I", 1) + b"".join(
    struct.pack(">I", len(f)) + f for f in (WIRE, b"\x01" * 64))


def b64(data: bytes) -> str:
    return base64.b64encode(data).decode()


def kinds(text: str) -> list[str]:
    return sorted(k for _, _, k in secrets.structural_spans(text))


@pytest.mark.parametrize("data", [PRIVATE, PUBLIC, WIRE, OPENSSH], ids=["private", "public", "wire", "openssh"])
def test_keys_are_confirmed_by_their_nested_lengths(data):
    assert kinds(f"see {b64(data)} here") == ["key"]
    assert kinds(f"see {b64(data[:-5])} here") == []
    assert kinds(f"see {b64(data + b'xx')} here") == []


def test_hex_and_armor():
    assert kinds(f"k={PRIVATE.hex()}") == ["key"]
    assert kinds(f"k={PRIVATE.hex()}00") == []
    body = "\n".join(b64(PRIVATE)[i:i + 64] for i in range(0, len(b64(PRIVATE)), 64))
    assert "armor" in kinds(f"-----BEGIN RSA PRIVATE KEY-----\n{body}\n-----END RSA PRIVATE KEY-----")
    assert "armor" not in kinds("-----BEGIN RSA PRIVATE KEY-----\nbm90IGEga2V5\n-----END RSA PRIVATE KEY-----")


def test_signed_tokens_need_a_header_that_names_an_algorithm():
    part = lambda v: base64.urlsafe_b64encode(json.dumps(v).encode()).decode().rstrip("=")
    assert kinds(f"x {part({'alg': 'HS256'})}.{part({'sub': 1})}.c2ln y") == ["token"]
    assert kinds(f"x {part({'typ': 'JWT', 'a': 1})}.{part({'sub': 1})}.c2ln y") == []
    assert kinds(f"x eyJub3QganNvbg.{part({'sub': 1})}.c2ln y") == []


def test_masking_merges_overlaps_and_leaves_the_rest():
    assert secrets.masked('a token = "0123456789abcdef0123" b') == 'a [secret]" b'
    assert secrets.masked("nothing here") == "nothing here"


WORDS = ["Licensed", "under", "the", "MIT", "License", "Apache", "License,", "Version", "2.0", "CC", "BY-NC", "by", "nc", "4.0", "É", "\x7f", "\n", "GNU", "General", "Public"]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(WORDS), max_size=16).map(" ".join))
def test_license_base_equals_the_plain_search(text):
    assert licenses._report(text)[:5] == plain.license_base(text)


@pytest.mark.parametrize("text,labels", [
    ("This work is licensed under the GNU General Public License, version 3.", "gpl-3"),
    ("SPDX-License-Identifier: BSD-3-Clause", "bsd-3"),
    ("see https://creativecommons.org/licenses/by-nc-sa/4.0/", "cc-by-nc-sa"),
    ("All rights reserved.", "all-rights-reserved"), ("she spoke of mit and eclipse", ""),
    ("Licensed under the Apache License, Version 2.0 and under the MIT license", "apache-2,mit"),
])
def test_labels(text, labels):
    assert licenses._report(text)[5] == labels


def test_contained_detections_of_lower_rank_go():
    low, high, apart = Detection("gpl", 60, 3, 6), Detection("gpl-3", 80, 2, 8), Detection("mit", 60, 7, 10)
    assert suppressed([low, high, apart]) == [high, apart]


def test_there_are_hundreds_of_rules():
    assert len(rules()) > 300 and all(r.keywords for r in rules())
    assert [r.priority for r in rules()] == sorted((r.priority for r in rules()), reverse=True)
