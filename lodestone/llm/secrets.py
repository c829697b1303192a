"""Secret scans: fixed patterns, then a character convolutional network over every further candidate in its context.

Candidates are, wherever no fixed pattern covers them whole: tokens of 16 or more of the characters that keys are written
in, with a letter and a digit or with capitals inside; what is assigned to a word for credentials, and passwords in
addresses, from 6 characters and with a digit, a sign or capitals inside. The network reads ``BEFORE`` characters ahead of
the candidate, the candidate, and ``AFTER`` characters behind it; one of more than ``INSIDE`` characters is read in windows
that overlap by half, and its score is the greatest. It is trained with numpy on labelled findings (by default a seeded
set of generated ones), its scores are calibrated by Platt scaling on held-out findings, and its threshold is the highest
that still recalls ``RECALL`` of the held-out secrets.

Spans are in code points, end exclusive. Kinds: assign, access, hex (the patterns; always reported) and cnn (added).

Defined cases: null or empty text has no findings; very long texts are scanned whole; repeated rows are alike; malformed
UTF-8 is read with replacement characters, each a code point; an empty table gives an empty result; other columns are not
looked at.
"""

from __future__ import annotations

import hashlib
import random
import re
import string
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import byte_texts, map_arrow

KINDS = ("assign", "access", "hex", "cnn")
ASSIGN = re.compile(r"""((?ai:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
_WORDS = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")
_TOKEN = re.compile(r"[A-Za-z0-9+/_.=-]{16,}")
_ASSIGNED = re.compile(r"""(?ai:\b(?:pw|pwd|pass|passphrase|passcode|credentials?|auth|bearer|key|private|client|access)[a-z_-]{0,12})["']?\x20{0,2}[:=]\x20{0,2}["']?([^\s"'<>]{6,})""")
_ADDRESS = re.compile(r"://[^\s/:@]{1,64}:([^\s/@]{6,})@")
_HINTS = (b"pw", b"pass", b"cred", b"auth", b"bearer", b"key", b"private", b"client", b"access", b"://")
_INNER = re.compile(r"[a-z0-9][A-Z]")
_LONE = bytes(range(48, 58)) + bytes(range(65, 91))
_NOT_ASCII = re.compile(r"[^\x00-\x7e]")
_HEX_MASK = bytes(104 if chr(b) in "0123456789abcdef" else 32 for b in range(256))
BEFORE, INSIDE, AFTER = 32, 64, 32
WIDTH, FILTERS, EMBED = 5, 32, 12
_PLACE = 128 * np.repeat([0, 1, 2], [BEFORE, INSIDE, AFTER])
RECALL = 0.97


class Net(NamedTuple):
    embed: np.ndarray  # 128 characters ahead of, in, and behind the candidate x EMBED
    conv: np.ndarray  # WIDTH x EMBED x FILTERS
    bias: np.ndarray
    dense: np.ndarray  # of the greatest and the mean of each filter
    offset: float
    scale: float  # Platt: probability = sigmoid(scale * score + shift)
    shift: float
    threshold: float


def base_spans(text: str, raw: bytes) -> list[tuple[int, int, int]]:
    """(start, end, kind number) of the fixed patterns."""
    found = []
    low = raw.lower()
    if any(w in low for w in _WORDS):
        found += [(*m.span(), 0) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    if b"AKIA" in raw:
        found += [(*m.span(), 1) for m in ACCESS.finditer(text) if len(m[0]) >= 20]
    if b"h" * 24 in raw.translate(_HEX_MASK):
        found += [(*m.span(), 2) for m in HEX.finditer(text)]
    return sorted(found, key=lambda x: (x[0], x[2]))


def candidates(text: str, raw: bytes, taken: list[tuple[int, int, int]]) -> list[tuple[int, int]]:
    """The spans for the network, ascending."""
    found = set()
    if len(raw.translate(None, _LONE)) < len(raw):  # a digit or a capital somewhere
        for m in _TOKEN.finditer(text):
            x = m[0]
            if (any(c.isdigit() for c in x) and any(c.isalpha() for c in x)) or len(_INNER.findall(x)) >= 2:
                found.add(m.span())
    low = raw.lower()
    if any(h in low for h in _HINTS):
        for pattern in (_ASSIGNED, _ADDRESS):
            for m in pattern.finditer(text):
                x = m[1].rstrip(".,;:)]}")
                if len(x) >= 6 and (any(not c.isalpha() for c in x) or _INNER.search(x)):
                    found.add((m.start(1), m.start(1) + len(x)))
    if found:  # a span inside another is read with it
        spans = sorted(found, key=lambda x: (x[0], -x[1]))
        outer, end = [], -1
        for a, b in spans:
            if b > end:
                outer.append((a, b))
                end = b
        return _outside(outer, taken)
    return []


def _outside(spans: list[tuple[int, int]], taken: list[tuple[int, int, int]]) -> list[tuple[int, int]]:
    """The spans, ascending, that none of the taken ones, ascending too, covers whole: one sweep over both."""
    out, at, end = [], 0, -1
    for a, b in spans:
        while at < len(taken) and taken[at][0] <= a:
            end = max(end, taken[at][1])
            at += 1
        if end < b:
            out.append((a, b))
    return out


def window(text: str, a: int, b: int) -> bytes:
    """The characters that the network reads, one byte each: 0 outside the text, 127 for anything but ASCII."""
    head = text[max(0, a - BEFORE) : a].rjust(BEFORE, "\0")
    inside = text[a:b] if b - a <= INSIDE else text[a : a + INSIDE // 2] + text[b - INSIDE // 2 : b]
    return _NOT_ASCII.sub("\x7f", head + inside.ljust(INSIDE, "\0") + text[b : b + AFTER].ljust(AFTER, "\0")).encode()


def windows_of(text: str, a: int, b: int) -> list[bytes]:
    """The token's window; a token of more than INSIDE characters has also one for each INSIDE of them, half overlapping."""
    out = [window(text, a, b)]
    if b - a > INSIDE:
        starts = [*range(a, b - INSIDE, INSIDE // 2), b - INSIDE]
        out += [window(text, k, k + INSIDE) for k in starts]
    return out


def _codes(windows: list[bytes]) -> np.ndarray:
    """Characters as numbers that also tell whether they are ahead of the candidate, in it or behind it."""
    return (np.frombuffer(b"".join(windows), np.uint8).reshape(len(windows), -1).astype(np.int64) & 127) + _PLACE


def score(net: Net, windows: list[bytes]) -> np.ndarray:
    """Probabilities that the windows hold secrets."""
    if not windows:
        return np.zeros(0)
    tables = np.einsum("ve,kef->kvf", net.embed, net.conv)
    out = []
    for k in range(0, len(windows), 256):
        x = _codes(windows[k : k + 256])
        n = x.shape[1] - WIDTH + 1
        h = sum(tables[j][x[:, j : j + n]] for j in range(WIDTH)) + net.bias
        h = np.maximum(h, 0)
        out.append(np.concatenate([h.max(1), h.mean(1)], axis=1) @ net.dense + net.offset)
    return 1 / (1 + np.exp(-(net.scale * np.concatenate(out) + net.shift)))


# --- labelled findings and training ---------------------------------------------------------------------------------


def _pick(r: random.Random, chars: str, low: int, high: int) -> str:
    return "".join(r.choices(chars, k=r.randint(low, high)))


def generated_findings(seed: int = 7, n: int = 6000) -> list[tuple[str, int, int, int]]:
    """Labelled findings (text, start, end, label): secrets of many shapes, and tokens that merely look alike."""
    r = random.Random(seed)
    alnum, lower, b64, digits = string.ascii_letters + string.digits, string.ascii_lowercase, string.ascii_letters + string.digits + "+/", string.digits
    parts = ["tion", "ing", "er", "and", "the", "re", "un", "ment", "lich", "ung", "eau", "que", "dad", "ción", "os", "ent", "st", "ver", "in", "on", "al", "com", "pre", "ge", "sch"]
    syllables = lambda: "".join(r.choices(parts, k=r.randint(1, 4))).replace("ó", "o")
    word = lambda: syllables() if r.random() < 0.5 else _pick(r, lower, 2, 9)
    secrets = [
        lambda: "ghp_" + _pick(r, alnum, 36, 36),
        lambda: "sk_live_" + _pick(r, alnum, 24, 32),
        lambda: "xoxb-" + _pick(r, digits, 11, 12) + "-" + _pick(r, alnum, 24, 24),
        lambda: "eyJ" + _pick(r, b64, 20, 40) + "." + _pick(r, b64, 40, 300) + "." + _pick(r, b64, 30, 43),
        lambda: _pick(r, b64, 40, 40),
        lambda: _pick(r, b64, 42, 86) + "==",
        lambda: _pick(r, b64, 100, 500),
        lambda: "AIza" + _pick(r, alnum + "-_", 35, 35),
        lambda: _pick(r, alnum, 16, 64),
        lambda: _pick(r, string.ascii_letters, 24, 64),
        lambda: _pick(r, "0123456789ABCDEF", 32, 64),
        lambda: _pick(r, lower, 2, 8) + r.choice("-_.") + _pick(r, alnum, 18, 64),
        lambda: _pick(r, lower, 2, 6) + r.choice("-_") + _pick(r, lower, 2, 5) + r.choice("-_") + _pick(r, alnum + "-_", 20, 48),
        lambda: _pick(r, string.ascii_uppercase, 2, 4) + "." + _pick(r, alnum + "-_", 20, 24) + "." + _pick(r, alnum + "-_", 40, 46),
        lambda: _pick(r, lower + digits, 24, 48),
        lambda: _pick(r, alnum, 3, 8) + r.choice("!$%&*#@^") + _pick(r, alnum + "!$%&*#@^", 3, 10),  # passwords
        lambda: _pick(r, alnum, 8, 15) + _pick(r, digits, 1, 2),
    ]
    others = [
        lambda: f"{word()}{r.randint(0, 99)}.{word()}.{r.choice(['com', 'org', 'net'])}",
        lambda: f"{r.choice(['mail', 'smtp', 'mx', 'imap', 'www', 'host', 'srv'])}{r.randint(0, 99)}.{r.choice([word(), 'example', 'test'])}.{r.choice(['com', 'org', 'net', 'de', 'fr'])}",
        lambda: f"{r.choice(['mail', 'mx', 'www'])}{r.randint(0, 9)}.{word()}{word()}.{r.choice(['com', 'org', 'net'])}",
        lambda: f"www.{word()}{r.randint(1, 999)}.example.org/{word()}/{word()}",
        lambda: f"{word()}.{word()}.{r.choice(['com', 'org', 'net'])}/{word()}/{r.randint(1, 99999)}",
        lambda: f"{r.randint(1990, 2030)}-{r.randint(1, 12):02d}-{r.randint(1, 28):02d}T{r.randint(0, 23):02d}",
        lambda: f"/{word()}/{word()}/{word()}_{r.randint(1, 99)}.{r.choice(['py', 'txt', 'html', 'jpeg'])}",
        lambda: f"{word()}_{word()}_{word()}{r.randint(0, 999)}",
        lambda: f"{word()}-{word()}-{word()}-{r.randint(1, 99)}",
        lambda: "-".join(word() for _ in range(r.randint(3, 9))) + f"-{r.randint(1, 9999)}",
        lambda: f"{word()}{word()}{word()}{r.randint(0, 99)}",
        lambda: f"{word()}{word()}{r.randint(0, 99)}.{word()}{word()}",
        lambda: word().capitalize() + word().capitalize() + word().capitalize() + str(r.randint(1, 9)),
        lambda: "".join(word().capitalize() for _ in range(r.randint(3, 6))),
        lambda: word() + "".join(word().capitalize() for _ in range(r.randint(2, 5))),
        lambda: f"v{r.randint(0, 9)}.{r.randint(0, 20)}.{r.randint(0, 99)}-{r.choice(['alpha', 'beta', 'release'])}.{r.randint(1, 9)}",
        lambda: f"{_pick(r, lower, 7, 18)}{r.choice('.=-')}{_pick(r, lower, 7, 18)}{r.randint(0, 9)}",
        lambda: f"{word()}={word()}.{word()}.{r.randint(0, 99)}",
        lambda: "=" * r.randint(16, 40) + word() + str(r.randint(0, 9)),
        lambda: r.choice(["_", "-", ".", "="]) * r.randint(14, 30) + f"{word()}{r.randint(0, 9)}",
        lambda: f"{r.randint(1, 255)}.{r.randint(0, 255)}.{r.randint(0, 255)}.{r.randint(0, 255)}",
        lambda: f"{word()}{r.randint(0, 2030)}",
        lambda: f"{r.randint(0, 99)}.{r.randint(0, 999)}%",
        lambda: f"{word()}/{word()}",
        lambda: f"(0{r.randint(10, 99)}){r.randint(100, 999)}-{r.randint(1000, 9999)}",
    ]
    around = [" {} ", " key {} ", " key: {} ", " credential {} used ", " Bearer {}\n", ' "{}" ', " see {} for ", " {}, ", "({}) ", " id={};", "\n{}\n", " pw={} ", " passphrase: {}\n", " https://user:{}@host", " auth = '{}'", " access: {} "]
    # What stands around a token is words for the most part, and now and then numbers, signs and other people's keys.
    other = [lambda: _pick(r, digits, 4, 16), lambda: word() + r.choice(["###", "***", "$$$", "%%%", "&&&", ",", "."]), lambda: f'token = "{_pick(r, "0123456789abcdef", 40, 40)}"', lambda: _pick(r, alnum, 8, 40)]
    near = lambda: r.choice(other)() if r.random() < 0.15 else word()
    out = []
    for k in range(n):
        label = k % 2
        token = r.choice(secrets if label else others)()
        before, after = r.choice(around[11:] if len(token) < 16 else around).split("{}")
        lead = " ".join(near() for _ in range(r.randint(0, 9))) + before
        if token.endswith((".com", ".org", ".net", ".de", ".fr")) and r.random() < 0.7:  # the host of an address
            lead += f"{word()}{r.choice(['.', '', '_'])}{r.randint(0, 99)}@"
        tail = (after if r.random() < 0.9 else r.choice(["###", "***", "&&& ", ";", "|"])) + " ".join(near() for _ in range(r.randint(0, 9)))
        out.append((lead + token + tail, len(lead), len(lead) + len(token), label))
    return out


def train(findings: list[tuple[str, int, int, int]], *, seed: int = 11, epochs: int = 10, rate: float = 0.01, recall: float = RECALL) -> Net:
    """Fit the network with Adam on the windows of four fifths of the findings; calibrate and set the threshold on the
    scores of the rest, each the greatest of its windows."""
    rng = np.random.default_rng(seed)
    read = [windows_of(t, a, b) for t, a, b, _ in findings]
    of = np.repeat(np.arange(len(read)), [len(w) for w in read])
    x = _codes([w for windows in read for w in windows])
    y = np.array([label for *_, label in findings], np.float64)
    held = np.arange(len(y)) % 5 == 4
    xt, yt, n = x[~held[of]], y[of][~held[of]], x.shape[1] - WIDTH + 1
    p = [rng.normal(0, 0.3, (3 * 128, EMBED)), rng.normal(0, 0.2, (WIDTH, EMBED, FILTERS)), np.zeros(FILTERS), rng.normal(0, 0.2, 2 * FILTERS), np.zeros(1)]
    m, v, step = [np.zeros_like(q) for q in p], [np.zeros_like(q) for q in p], 0

    def forward(xb):
        e = p[0][xb]
        h = sum(e[:, j : j + n] @ p[1][j] for j in range(WIDTH)) + p[2]
        a = np.maximum(h, 0)
        top = a.argmax(1)
        pooled = np.concatenate([np.take_along_axis(a, top[:, None], 1)[:, 0], a.mean(1)], axis=1)
        return e, h, top, pooled, pooled @ p[3] + p[4][0]

    for _ in range(epochs):
        order = rng.permutation(len(yt))
        for k in range(0, len(order), 64):
            at = order[k : k + 64]
            e, h, top, pooled, z = forward(xt[at])
            dz = (1 / (1 + np.exp(-z)) - yt[at]) / len(at)
            dh = np.repeat((dz[:, None] * p[3][FILTERS:] / n)[:, None], n, axis=1)
            i, f = np.ogrid[: len(at), :FILTERS]
            dh[i, top, f] += dz[:, None] * p[3][:FILTERS]
            dh *= h > 0
            dconv, de = np.zeros_like(p[1]), np.zeros_like(e)
            for j in range(WIDTH):
                dconv[j] = np.tensordot(e[:, j : j + n], dh, axes=([0, 1], [0, 1]))
                de[:, j : j + n] += dh @ p[1][j].T
            dembed = np.zeros_like(p[0])
            np.add.at(dembed, xt[at], de)
            step += 1
            for q, g, mm, vv in zip(p, (dembed, dconv, dh.sum((0, 1)), pooled.T @ dz, np.array([dz.sum()])), m, v, strict=True):
                mm += 0.1 * (g - mm)
                vv += 0.001 * (g * g - vv)
                q -= rate * (mm / (1 - 0.9**step)) / (np.sqrt(vv / (1 - 0.999**step)) + 1e-8)
    z = np.full(len(y), -np.inf)
    np.maximum.at(z, of[held[of]], np.concatenate([forward(part)[-1] for part in np.array_split(x[held[of]], 16)]))
    z, yh = z[held], y[held]
    scale, shift = 1.0, 0.0
    for _ in range(200):  # Platt scaling; targets a little inside 0 and 1
        q = 1 / (1 + np.exp(-(scale * z + shift)))
        g = q - (yh * 0.98 + 0.01)
        scale, shift = scale - 0.05 * float((g * z).mean()), shift - 0.05 * float(g.mean())
    prob = 1 / (1 + np.exp(-(scale * z + shift)))
    secrets = np.sort(prob[yh == 1])
    threshold = float(secrets[int((1 - recall) * len(secrets))]) if len(secrets) else 1.0
    return Net(p[0], p[1], p[2], p[3], float(p[4][0]), scale, shift, threshold)


@lru_cache(maxsize=1)
def default_net() -> Net:
    return train(generated_findings())


def scan(docs: DataFrame, net: Net | None = None, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows doc_id, n_assign, n_access, n_hex, base_sha256, spans (kind:start:end by start, then kind), n_cnn."""
    shared = docs.sparkSession.sparkContext.broadcast(net or default_net())
    schema = f"doc_id {dict(docs.dtypes)[id_col]}, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_cnn long"
    joined = lambda spans: ",".join(f"{KINDS[k]}:{a}:{b}" for a, b, k in spans)

    def each(batch: pa.RecordBatch) -> dict:
        net, spans, more, windows = shared.value, [], [], []
        for row, raw in enumerate(byte_texts(batch.column(1))):
            text = raw.decode("utf-8", "replace")
            spans.append(base_spans(text, raw))
            for a, b in candidates(text, raw, spans[-1]):
                read = windows_of(text, a, b)
                more += [(row, a, b)] * len(read)
                windows += read
        base = [joined(s) for s in spans]
        counts = [[sum(k == kind for *_, k in s) for s in spans] for kind in range(3)]
        added = [0] * len(spans)
        hits = {token for token, p in zip(more, score(net, windows), strict=True) if p >= net.threshold}
        for row, a, b in hits:
            spans[row].append((a, b, 3))
            added[row] += 1
        return {
            "doc_id": batch.column(0), "n_assign": counts[0], "n_access": counts[1], "n_hex": counts[2], "n_cnn": added,
            "base_sha256": [hashlib.sha256(s.encode()).hexdigest() for s in base],
            "spans": [joined(sorted(s, key=lambda x: (x[0], x[2]))) for s in spans],
        }

    return map_arrow(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("_text")), schema, each)
