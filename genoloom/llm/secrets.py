"""Secret scan: an Aho-Corasick pass finds keywords, regular expressions are tried only there, checksums decide the rest.

Three base kinds (assign, access, hex) have fixed patterns and no checksum. Further kinds carry a checksum of their own and
count only when it holds: token (prefix, 30 characters, and their CRC-32 in six base-62 digits), card (Luhn) and iban (mod 97).
More digits or capitals may follow a card or an iban after a blank: every end of a card is tried, the longest first, and of an
iban its country's length, then the longest end (all ends for other countries). Where none holds, the next start is tried.
Runs of hex digits and of decimal digits have no keyword; a byte table finds runs that are long enough, and the expression
is matched there only. All work is per text and in one pass; nothing is shuffled. A null or empty text has no spans; a text
of any length is scanned whole; repeated rows are scanned each; other columns are ignored; an empty table gives an empty
result. Spans count code points, end exclusive.
"""

from __future__ import annotations

import hashlib
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from .common import batches, table

KINDS = ("assign", "access", "hex", "token", "card", "iban")
BASE = KINDS[:3]
ASSIGN = rb"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
ACCESS = rb"AKIA[A-Z0-9]+"
HEX = rb"[0-9a-f]+"
TOKEN = rb"(?:gh[pousr]_|npm_)([A-Za-z0-9]{30})([A-Za-z0-9]{6})(?![A-Za-z0-9])"
CARD = rb"[0-9](?:[ -]?[0-9]){12,18}(?![0-9])"
IBAN = rb"[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30}(?![A-Za-z0-9])"
#: Characters of an iban by country.
LENGTHS = {n: c.split() for n, c in ((15, "NO"), (16, "BE"), (18, "DK FO FI GL NL SD FK"), (19, "MK SI"), (20, "AT BA EE KZ LT LU XK MN"), (21, "CH HR LI LV"), (22, "BG BH CR DE GB GE IE ME RS VA"), (23, "AE GI IL IQ TL OM SO"), (24, "AD CZ ES MD PK RO SA SE SK TN VG"), (25, "LY PT ST"), (26, "IS TR"), (27, "BI DJ FR GR IT MC MR SM"), (28, "AL AZ BY CY DO GT HU LB NI PL SV"), (29, "BR EG PS QA UA"), (30, "JO KW MU"), (31, "MT SC"), (32, "LC"), (33, "RU"))}
LENGTH = {c.encode(): n for n, countries in LENGTHS.items() for c in countries}
KEYWORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
TOKEN_KEYWORDS = ("ghp_", "gho_", "ghu_", "ghs_", "ghr_", "npm_")
DIGITS62 = b"0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
SCHEMA = "doc_id bigint, n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, spans string"


def crc62(body: bytes) -> bytes:
    """The CRC-32 of body as six base-62 digits."""
    v, out = zlib.crc32(body), b""
    for _ in range(6):
        v, r = divmod(v, 62)
        out = DIGITS62[r : r + 1] + out
    return out


def luhn(digits: bytes) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        v = (d - 48) * (1 + i % 2)
        total += v - 9 * (v > 9)
    return total % 10 == 0 and len(set(digits)) > 1


def mod97(code: bytes) -> bool:
    return int("".join(str(int(chr(c), 36)) for c in code[4:] + code[:4])) % 97 == 1


def runs_of(mask: np.ndarray, least: int) -> list[tuple[int, int]]:
    edge = np.flatnonzero(np.diff(np.concatenate(([0], mask.view(np.int8), [0]))))
    begin, end = edge[0::2], edge[1::2]
    long = end - begin >= least
    return list(zip(begin[long].tolist(), end[long].tolist(), strict=True))


class Scanner:
    """Holds the automaton and the compiled expressions; one for each task."""

    def __init__(self):
        import ahocorasick

        self.words = ahocorasick.Automaton()
        for w in KEYWORDS:
            self.words.add_word(w, ("assign", len(w)))
        self.words.add_word("akia", ("access", 4))
        for w in TOKEN_KEYWORDS:
            self.words.add_word(w, ("token", len(w)))
        self.words.make_automaton()
        self.re = {"assign": re.compile(ASSIGN, re.I), "access": re.compile(ACCESS), "hex": re.compile(HEX), "token": re.compile(TOKEN), "card": re.compile(CARD), "iban": re.compile(IBAN)}
        self.cards = [re.compile(rb"[0-9](?:[ -]?[0-9]){%d}(?![0-9])" % n) for n in range(18, 11, -1)]
        self.ibans = {n: re.compile(rb"[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){%d}(?![A-Za-z0-9])" % (n - 4)) for n in range(34, 14, -1)}
        self.hex = np.zeros(256, bool)
        self.hex[list(b"0123456789abcdef")] = True
        self.digit = np.zeros(256, bool)
        self.digit[48:58] = True
        self.alnum = np.zeros(256, bool)
        self.alnum[[*range(48, 58), *range(65, 91), *range(97, 123)]] = True

    def _at(self, kind: str, data: bytes, starts, ok) -> list[tuple[int, int, str]]:
        """Leftmost matches of a kind that do not overlap, tried at the given starts only; ok says which of them count."""
        out, past, pattern = [], 0, self.re[kind]
        for s in starts:
            if s < past:
                continue
            m = pattern.match(data, s)
            if m:
                past = m.end()
                if ok(m):
                    out.append((m.start(), past, kind))
        return out

    def _checked(self, kind: str, data: bytes, starts, ends, ok) -> list[tuple[int, int, str]]:
        """Matches that do not overlap: at each of the given starts, the first of ends (expressions, given the longest match) that is ok."""
        out, past = [], 0
        for s in starts:
            longest = self.re[kind].match(data, s) if s >= past else None
            if longest:
                m = next((m for p in ends(longest) if (m := p.match(data, s)) and ok(m)), None)
                if m:
                    past = m.end()
                    out.append((s, past, kind))
        return out

    def _iban_ends(self, longest) -> list:
        n = LENGTH.get(longest[0][:2])
        return list(self.ibans.values()) if n is None else [self.ibans[n], self.re["iban"]]

    def scan(self, data: bytes, hex_runs: list, digit_runs: list) -> list[tuple[int, int, str]]:
        """(start, end, kind) of one text, in bytes. hex_runs, digit_runs: maximal runs of at least 16 hex digits and starts of decimal runs."""
        at: dict[str, list[int]] = {"assign": [], "access": [], "token": []}
        for end, (kind, n) in self.words.iter(data.lower().decode("latin-1")):
            at[kind].append(end - n + 1)
        out = self._at("assign", data, sorted(at["assign"]), lambda m: m.end(2) - m.start(2) >= 12)
        out += self._at("access", data, at["access"], lambda m: m.end() - m.start() >= 18)
        out += [(s, e, "hex") for s, e in hex_runs]
        out += self._at("token", data, sorted(at["token"]), lambda m: crc62(m[1]) == m[2])
        free = [s for s in digit_runs if not (s and self.alnum[data[s - 1]])]
        out += self._checked("card", data, free, lambda m: self.cards, lambda m: luhn(re.sub(rb"[ -]", b"", m[0])))
        lands = [s - 2 for s in digit_runs if s >= 2 and data[s - 2 : s].isalpha() and data[s - 2 : s].isupper() and not (s >= 3 and self.alnum[data[s - 3]])]
        out += self._checked("iban", data, lands, self._iban_ends, lambda m: mod97(m[0].replace(b" ", b"")))
        return sorted(out, key=lambda x: (x[0], KINDS.index(x[2])))

    def block(self, texts: list) -> list[list[tuple[int, int, str]]]:
        """Spans of each text, in code points."""
        parts = [(t or "").encode() for t in texts]
        buf = np.frombuffer(b"\n".join(parts) + b"\n", np.uint8)
        starts = np.zeros(len(parts) + 1, np.int64)
        np.cumsum([len(p) + 1 for p in parts], out=starts[1:])
        hexes, digits = runs_of(self.hex[buf], 16), [s for s, e in runs_of(self.digit[buf], 2)]
        hex_doc = np.searchsorted(starts, [s for s, _ in hexes], "right") - 1
        dig_doc = np.searchsorted(starts, digits, "right") - 1
        by: dict[int, tuple[list, list]] = {}
        for d, (s, e) in zip(hex_doc.tolist(), hexes, strict=True):
            by.setdefault(d, ([], []))[0].append((s - int(starts[d]), e - int(starts[d])))
        for d, s in zip(dig_doc.tolist(), digits, strict=True):
            by.setdefault(d, ([], []))[1].append(s - int(starts[d]))
        out = []
        for d, data in enumerate(parts):
            found = self.scan(data, *by.get(d, ((), ())))
            if found and not data.isascii():
                lead = np.concatenate(([0], np.cumsum((np.frombuffer(data, np.uint8) & 0xC0) != 0x80)))
                found = [(int(lead[s]), int(lead[e]), k) for s, e, k in found]
            out.append(found)
        return out


def scan_secrets(docs: DataFrame) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256 and spans for every row of docs (doc_id, text)."""

    def scan(it):
        scanner = Scanner()
        for block in batches(it):
            rows = []
            for doc_id, found in zip(block["doc_id"], scanner.block(block["text"]), strict=True):
                join = lambda xs: ",".join(f"{k}:{s}:{e}" for s, e, k in xs)
                base = [x for x in found if x[2] in BASE]
                n = [sum(x[2] == k for x in base) for k in BASE]
                rows.append((doc_id, *n, hashlib.sha256(join(base).encode()).hexdigest(), join(found)))
            cols = list(zip(*rows, strict=True))
            types = [pa.int64()] * 4 + [pa.string()] * 2
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)], names=["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"])

    return docs.selectExpr("cast(doc_id as bigint) doc_id", "cast(text as string) text").mapInArrow(scan, SCHEMA)


def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_secrets(table(spark, sf_dir, "documents"))
