import base64
import bz2
import gzip
import hashlib
import random
import re
import tracemalloc
import urllib.parse
import zlib

import pytest

from carestar.llm.secrets import KINDS, base_spans, listed, redact_column, redacted, scan, scan_secrets
from tests.llm.cases import edge_rows, empty, frame

KEY = "24be64439e3e49cf46b2d7c90f3602a3d0b907ff"
SECRET = f'token = "{KEY}"'


def b64(x):
    return base64.b64encode(x if isinstance(x, bytes) else x.encode()).decode()


def escaped(x):
    return "".join(f"\\u{ord(c):04x}" for c in x)


def plain_spans(text):
    """The stated patterns, read literally."""
    assign = (
        r"""((?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]"""
        r"""|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY]))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
    )
    found = [(m.start(), 0, m.end()) for m in re.finditer(assign, text) if len(m[2]) >= 12]
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 16]
    return sorted(found)


def test_base_spans_are_the_stated_patterns():
    rng = random.Random(5)
    parts = ["token", "PassWord", "api_key", "ſecret", "Kelvin", "=", ": ", "'", '"', KEY[:14], KEY, "AKIA",
             "ABCDEFGH0123456", "secret", " ", "é", "-._", "AKIAAKIA", "toKen", "pass", "wd", "\n"]
    for _ in range(5000):
        text = "".join(rng.choice(parts) for _ in range(rng.randrange(12)))
        assert base_spans(text) == plain_spans(text), repr(text)


@pytest.mark.parametrize(
    "wrap",
    [
        lambda s: b64(s),
        lambda s: b64(b64(s)),
        lambda s: urllib.parse.quote(s, safe=""),
        lambda s: urllib.parse.quote(urllib.parse.quote(s, safe=""), safe=""),
        lambda s: "".join(f"%{b:02X}" for b in s.encode()),
        escaped,
        lambda s: "".join(f"&#x{ord(c):x};" for c in s),
        lambda s: b64(gzip.compress(s.encode())),
        lambda s: b64(zlib.compress(gzip.compress(s.encode()))),
        lambda s: b64(gzip.compress(urllib.parse.quote(b64(s), safe="").encode())),
        lambda s: urllib.parse.quote(b64(escaped(s)), safe=""),
        lambda s: base64.encodebytes((s + " lorem ipsum" * 20).encode()).decode(),
    ],
)
def test_nested_layers_are_opened_and_mapped(wrap):
    inner = wrap(SECRET)
    text = f"Vor é dem {inner} nach"
    _, spans, layers, closed = scan(text)
    assert layers and not closed
    low = text.index(inner)
    inside = [s for s in spans if s[1] == 0]
    assert inside and all(low <= s < e <= low + len(inner) for s, _, e in inside)
    assert KEY not in str([scan(redacted(text, spans))])
    assert not scan(redacted(text, spans))[1]


def test_exact_mapping_of_percent_and_base64():
    text = "x %74oken%3D%22" + KEY + "%22 y"
    assert (2, 0, text.index(KEY) + len(KEY)) in scan(text)[1]
    lead = "abc def "
    run = b64(lead + SECRET + " tail tail tail")
    low, _, high = next(s for s in scan(run)[1] if s[1] == 0)
    decoded = base64.b64decode(run[low // 4 * 4 : -(-high // 4) * 4]).decode()
    assert SECRET[:-1] in decoded and len(decoded) <= len(SECRET) + 4


def test_ordinary_texts_and_junk_open_nothing():
    for text in ("", "word%%% de%%% " * 50, "thehouseofthewindingstair " * 20, KEY, "100% &# \\u12"):
        assert scan(text)[2] == 0


def test_a_layer_met_again_ends_the_work():
    text = "%2525252541" + b64("%41 " * 20)
    _, _, layers, _ = scan(text)
    assert layers < 12


def test_a_stretch_that_cannot_be_parted_is_counted():
    bomb = b64(gzip.compress(b"a" * 3_000_000))
    assert scan(bomb, limit=1 << 20)[3] == 1


@pytest.mark.parametrize("pack, times", [(gzip.compress, 90), (bz2.compress, 12)])
def test_a_layer_of_any_size_is_looked_through_to_its_end(pack, times):
    lines = b"".join(b"%d, nothing of note is said in this line, nor was it ever\n" % (k % 97) for k in range(20_000))
    big = lines * times  # over 100 MB, and 14
    nested = b"\x00\x01" + gzip.compress(b"found: " + SECRET.encode()) + b"\x00"
    text = "see " + b64(pack(big + SECRET.encode() + b"\n" + lines + nested)) + " end"
    tracemalloc.start()
    _, spans, _, closed = scan(text)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert spans == [(4, 0, len(text) - 4), (4, 2, len(text) - 4)] and not closed
    assert peak < 100 << 20


def test_pieces_are_held_one_at_a_time():
    lines = b"".join(b"%d, as said, and as said before\n" % (k % 97) for k in range(4_000))
    runs = [b64(gzip.compress(b"%d\n" % k + lines * 40 + (SECRET.encode() if k == 15 else b""))) for k in range(16)]
    tracemalloc.start()
    spans = scan("\n".join(runs))[1]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(spans) == 2 and peak < 100 << 20


@pytest.mark.parametrize("size", [64, 1 << 10, 1 << 14])
def test_parts_lose_nothing_across_their_ends(monkeypatch, size):
    rng = random.Random(3)
    wraps = [
        str, b64, lambda s: b64(b64(s)), escaped, lambda s: urllib.parse.quote(s, safe=""),
        lambda s: base64.encodebytes((s + " lorem ipsum" * 30).encode()).decode(),
        lambda s: b64(gzip.compress(s.encode())),
    ]
    for _ in range(60):
        parts = [rng.choice([b"word, ", b"x^2 ", b"\n", b"(a)", b"abcdef/ghi", b"\xe9\x00", bytes(rng.randbytes(40))]) for _ in range(300)]
        place = rng.randrange(300)
        inner = rng.choice([w(SECRET).encode() for w in wraps] + [gzip.compress(SECRET.encode()), zlib.compress(SECRET.encode())])
        parts[place : place + 1] = [b", ", inner, b"\n"]
        text = b64(gzip.compress(b"".join(parts)))
        monkeypatch.setattr("carestar.llm.secrets.PART_BYTES", 1 << 30)
        want = scan(text)[1]
        monkeypatch.setattr("carestar.llm.secrets.PART_BYTES", size)
        assert (0, 0, len(text.rstrip("="))) in want or (0, 0, len(text)) in want
        assert scan(text)[1] == want and scan(text)[3] == 0


def test_very_deep_nesting_ends():
    data = SECRET.encode()
    for _ in range(1_200):
        data = zlib.compress(data, 0)
    assert any(k == 0 for _, k, _ in scan(b64(data))[1])


def test_overlapping_spans_are_masked_once():
    assert redacted("0123456789", [(1, 0, 4), (2, 2, 6), (8, 1, 9)]) == "0[SECRET]67[SECRET]9"


def test_rows(spark):
    rows = [*edge_rows(), (20, SECRET), (21, "é " + b64(SECRET)), (21, "é " + b64(SECRET))]
    got = scan_secrets(frame(spark, rows)).collect()
    want = []
    for i, t in rows:
        base, spans, layers, closed = scan(t or "")
        counts = [sum(k == n for _, k, _ in base) for n in range(len(KINDS))]
        digest = hashlib.sha256(listed(plain_spans(t or "")).encode()).hexdigest()
        want.append((i, *counts, digest, listed(spans), layers, closed))
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))
    assert scan_secrets(empty(spark)).collect() == []


def test_redacted_column(spark):
    rows = [(1, None), (2, "clean"), (3, SECRET), (4, "")]
    got = frame(spark, rows).select("doc_id", redact_column("text").alias("t")).collect()
    assert {r.doc_id: r.t for r in got} == {1: None, 2: "clean", 3: '[SECRET]"', 4: ""}


@pytest.mark.parametrize("odd", ["\u00a0", "\ufeff", "\u200b", "\u3000", "\u00ad", "\x00", "\x1b[0m", b"\xff", b"\xe9t\xe9"])
@pytest.mark.parametrize(
    "wrap", [b64, lambda s: b64(gzip.compress(s)), lambda s: "".join(f"%{b:02X}" for b in s), lambda s: b64(b64(s))]
)
def test_odd_characters_do_not_close_a_layer(odd, wrap):
    odd = odd if isinstance(odd, bytes) else odd.encode()
    inner = wrap(b"Le code" + odd + b": " + SECRET.encode() + odd + b" fin")
    text = f"voici {inner} l\u00e0"
    spans = scan(text)[1]
    low = text.index(inner)
    assert any(k == 0 and low <= s < e <= low + len(inner) for s, k, e in spans)
    assert not scan(redacted(text, spans))[1]


def test_bytes_that_are_no_text_keep_their_offsets():
    lead = b"\xff\xfe caf\xe9 \xc3\xa9 "
    run = b64(lead + SECRET.encode())
    low, _, high = next(s for s in scan(run)[1] if s[1] == 0)
    assert low == len(lead) * 4 // 3 and high == -(-(len(lead) + len(SECRET) - 1) * 4 // 3)


@pytest.mark.parametrize(
    "lead", ["id-", "https://h.example/cb/", "abcdefgh_", "a/", "ab+", "abc/d-", "/", "x" * 20 + "/y/", "k=v/w-", "path/to/some/thing/"]
)
@pytest.mark.parametrize("tail", ["", "/end", "-x1", "_abc"])
@pytest.mark.parametrize(
    "wrap",
    [
        b64,
        lambda s: base64.urlsafe_b64encode(s.encode()).decode().rstrip("="),
        lambda s: b64(b64(s)),
        lambda s: b64(gzip.compress(s.encode())),
        lambda s: b64(zlib.compress(s.encode())),
        lambda s: base64.encodebytes((s + " lorem ipsum" * 20).encode()).decode().rstrip(),
    ],
)
def test_payloads_after_other_base64_letters_are_opened(lead, tail, wrap):
    for secret in ("password=Zx9kQ27LmP04vT", SECRET):
        text = f"see {lead}{wrap(secret)}{tail} there"
        _, spans, _, closed = scan(text)
        low = text.index(lead)
        assert not closed
        assert any(k == 0 and low <= s < e <= len(text) - 6 for s, k, e in spans), text
        assert not scan(redacted(text, spans))[1]


def test_members_of_a_compressed_file_are_one_text():
    both = gzip.compress(SECRET[:20].encode()) + gzip.compress(SECRET[20:].encode())
    assert any(k == 0 for _, k, _ in scan(b64(both))[1])


@pytest.mark.parametrize("pack", [gzip.compress, zlib.compress])
def test_cut_and_broken_compressed_pieces_are_looked_through(pack):
    rng = random.Random(1)
    lines = "".join(f"{rng.random()} password = Zq{k:03d}hunterLongKey{k}\n" for k in range(40))
    whole = pack(lines.encode())
    text = f"log {base64.b64encode(whole[:-9]).decode()} end"
    assert scan(text)[1]
    broken = bytearray(whole)
    broken[len(whole) - 300 : len(whole) - 290] = b"\xff" * 10
    assert scan(f"log {base64.b64encode(bytes(broken)).decode()} end")[1]
    assert not scan(f"log {base64.b64encode(pack(bytes(range(256)) * 9)[:-9]).decode()} end")[1]
