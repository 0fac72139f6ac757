"""Private keys of all common shapes, and time on very long texts."""

import base64
import struct
import textwrap
import time

from tilewright.llm.secrets import KINDS, find_spans, redact


def armoured(kind, data, headers=""):
    return f"-----BEGIN {kind}-----\n{headers}" + "\n".join(textwrap.wrap(base64.b64encode(data).decode(), 64)) + f"\n-----END {kind}-----"


def field(data):
    return struct.pack(">I", len(data)) + data


def ssh(keys=1, spare=b""):
    body = b"openssh-key-v1\0" + field(b"aes256-ctr") + field(b"bcrypt") + field(b"x" * 24) + struct.pack(">I", keys)
    return body + field(b"public" * 9) * keys + field(b"private" * 30) + spare


def kinds(text):
    return [k for k, _, _ in find_spans(text) if k == "private_key"]


def test_keys_of_all_shapes_are_found_whole():
    der = b"\x30\x82\x01\x00" + b"k" * 256
    headers = "Proc-Type: 4,ENCRYPTED\nDEK-Info: AES-128-CBC,0123456789ABCDEF0123456789ABCDEF\n\n"
    good = [armoured("PRIVATE KEY", der), armoured("RSA PRIVATE KEY", der), armoured("OPENSSH PRIVATE KEY", ssh()), armoured("OPENSSH PRIVATE KEY", ssh(3)),
            armoured("RSA PRIVATE KEY", b"c" * 160, headers), armoured("EC PRIVATE KEY", der, "Comment: of mine\n")]
    for key in good:
        assert find_spans(f"é {key} z")[-1][1:] == (2, 2 + len(key)) and kinds(f"é {key} z") == ["private_key"], key
        assert redact(f"a {key} z") == "a [secret] z"
    bad = [armoured("PRIVATE KEY", der[:-1]), armoured("OPENSSH PRIVATE KEY", ssh(spare=b"12")), armoured("OPENSSH PRIVATE KEY", ssh()[:-3]), armoured("OPENSSH PRIVATE KEY", der),
           armoured("OPENSSH PRIVATE KEY", ssh(0)), armoured("OPENSSH PRIVATE KEY", b"openssh-key-v1\0" + b"\xff" * 40), armoured("RSA PRIVATE KEY", b"c" * 161, headers),
           armoured("RSA PRIVATE KEY", b"c" * 160), "-----BEGIN PRIVATE KEY-----\n!!\n-----END PRIVATE KEY-----", good[0].replace("END PRIVATE", "END RSA PRIVATE")]
    for key in bad:
        assert kinds(key) == [], key


def web(head='{"alg":"x"}', body='{"sub":1}'):
    part = lambda s: base64.urlsafe_b64encode(s.encode()).decode().rstrip("=")
    return f"{part(head)}.{part(body)}." + "s" * 20


def test_web_tokens_behind_a_run_that_is_none():
    assert [s[0] for s in find_spans(f"eyJeyJeyJ {web()} eyJa.eyJb")] == ["web_token"]
    assert [s[0] for s in find_spans(f"EYJ{web()}")] == ["web_token"]
    assert [s[0] for s in find_spans("eyJ" + "x" * 9 + "." + web())] == ["web_token"]


def seconds(text):
    began = time.perf_counter()
    found = find_spans(text)
    return time.perf_counter() - began, len(found)


def test_time_grows_with_the_text_only():
    long = [("eyJ" * 350_000, 0), ("é token=abcdefgh " * 60_000, 60_000), ("eyJ." * 250_000, 0), ("-----BEGIN A PRIVATE KEY-----\n" * 30_000, 0),
            ("token " + " " * 1_000_000, 0), ("-----BEGIN " + "A " * 400_000, 0), ("password" * 120_000, 0), ("eyJabcdefgh.eyJ" * 70_000, None)]
    for text, n in long:
        took, found = seconds(text)
        assert took < 4 and n in (None, found), (text[:30], took, found)
    assert len(KINDS) == 6
