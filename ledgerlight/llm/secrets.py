"""Secret scans: fixed patterns, and strings that a primed compressor cannot make shorter.

A candidate is a long run of key characters with letters and digits.  Where a sensitive word stands
before it in its line, or an assignment, its marginal size is measured: bytes of context and candidate,
less bytes of the context alone, under a dictionary of code and identifiers.  Novel strings are reported.
The lines after a sensitive one are sensitive as long as they hold candidates, or up to the END line.
Directly after a sensitive word, or in such a block, every run of 8 or more characters is a candidate,
and after any assignment one with letters and digits; plain words are prose unless a sensitive name is assigned them.
"""

from __future__ import annotations

import bisect
import hashlib
import itertools
import re
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from ledgerlight.llm.texts import LOWER, Words, own_names, slices, text_results

KINDS = ("assign", "access", "hex", "novel")
ASSIGN = re.compile(rb"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I)
ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
HEX = re.compile(rb"[0-9a-f]{32,}")
#: An equals sign is padding at the end of a run; before other key characters it is an assignment and parts them.
CANDIDATE = re.compile(rb"[A-Za-z0-9+/_-]{16,}(?:={1,2}(?![A-Za-z0-9+/_=-]))?")
#: A value after a sensitive word, and a shorter key after any assignment.
VALUE = re.compile(rb"[A-Za-z0-9+/_.!@#$%^&*~?-]{8,}(?:={1,2}(?![A-Za-z0-9+/_=-]))?")
_SENSITIVE = (b"key", b"token", b"secret", b"passw", b"pwd", b"auth", b"bearer", b"credential", b"private", b"signature", b"session")
SENSITIVE = re.compile(b"|".join(_SENSITIVE), re.I)
DIRECT = re.compile(rb"(?:%s)[A-Za-z0-9_]*(?:[\"'`\])]*[ \t]*(?::=|=>|([:=]))[ \t]*[\"'`(]*|(?:[ \t]+is)?[ \t]+[\"'`]?)$" % SENSITIVE.pattern, re.I)
PLAIN = re.compile(rb"(?:[A-Za-z][a-z]*|[A-Z]+)(?:[-/._](?:[A-Za-z][a-z]*|[A-Z]+))*")
SHORT = re.compile(rb"[A-Za-z0-9+/_-]{8,}")
ASSIGNED = re.compile(rb"[:=]\s*[\"']?$")
BEGIN, END = re.compile(rb"-----BEGIN [^-\n]*-----"), b"-----END"
LINE = re.compile(rb"[^\n]+")
#: What may stand around the one run of a line, and the mark of a list before it.
EDGES = b" \t\r\"'`,;|>*\\()[]{}"
MARK = re.compile(rb"(?:[-+]|[0-9]{1,4}[.)])[ \t]+[\"'`]?")
RUN = re.compile(rb"[A-Za-z0-9+/_=-]+")
LEAST_ASSIGN, LEAST_ACCESS = 8, 16
LEAST = 8                     # characters of a candidate in a strong context
BEFORE = 48                   # bytes in which a sensitive word is looked for, beyond the line
AROUND = 256                  # bytes of context that the compressor has seen
SHARED = 16                   # runs of so many bytes that are the candidate's own are no context
#: Marginal bytes per byte of a candidate, by its alphabet: three quarters of what a random string over it holds, half at most.
NOVELTY = 0.5
ALPHABETS = ((re.compile(rb"[0-9]+"), 0.31), (re.compile(rb"[0-9a-f]+|[0-9A-F]+"), 0.375), (re.compile(rb"[a-z2-7]+|[A-Z2-7]+"), 0.47))
#: Paths, dates, versions and names of several words or short numbers are no keys.  Parts are atomic, so a failing match is linear.
_SPOKEN = rb"(?:[A-Z]?[b-df-hj-np-tv-xz]*+[aeiouy][a-z]*+)"
_PART = rb"(?>v?[0-9]{1,4}+|%s++[0-9]{0,2}+|[A-Z]++|[a-z]{1,4}+[0-9]{0,2}+)" % _SPOKEN
ORDINARY = re.compile(rb"(?:~|\.{1,2})?/?%s(?:[-/._]%s)++/?|%s{2,}+[0-9]{0,2}" % (_PART, _PART, _SPOKEN))
#: Capitals that no one says: such a run is no plain word.
UNSAID = re.compile(rb"[B-DF-HJ-NP-TV-XZ]{5}")
FIELDS = [
    T.StructField("n_assign", T.LongType()), T.StructField("n_access", T.LongType()), T.StructField("n_hex", T.LongType()),
    T.StructField("base_sha256", T.StringType()), T.StructField("spans", T.StringType()), T.StructField("redacted", T.StringType()),
]
#: Words of code and configuration with which the compressor is primed.
VOCABULARY = (
    "public static private protected class interface function return import export const default string integer boolean "
    "true false null none self this new delete async await yield lambda struct enum void int float double char byte "
    "username password passwd secret token api_key apikey access_key secret_key private_key client_id client_secret "
    "authorization authentication bearer basic session cookie signature credentials certificate connection database "
    "localhost host port server endpoint region bucket service account project config configuration environment "
    "production development staging version release build debug verbose logging timeout retry request response header "
    "content-type application/json text/html charset utf-8 http:// https:// www. .com .org .net example /usr/local/bin "
    "/home/user/ /var/log/ node_modules index.html main.py __init__ README LICENSE 0123456789 abcdefghijklmnopqrstuvwxyz "
    "ABCDEFGHIJKLMNOPQRSTUVWXYZ 00000000 11111111 aaaaaaaa ffffffff deadbeef getElementById addEventListener "
    "StringBuilder ArrayList HashMap toString equals hashCode customer_id order_id created_at updated_at first_name "
    "last_name is_active max_length default_value"
)
_HEX = np.zeros(256, bool)
_HEX[48:58] = _HEX[97:103] = True
_KEY = np.zeros(256, bool)
_KEY[48:58] = _KEY[65:91] = _KEY[97:123] = True
_KEY[list(b"+/_=-")] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True


class Scanner:
    """One per task: the compressor and its dictionary are made once."""

    def __init__(self, identifiers: str = VOCABULARY):
        prime = zstandard.ZstdCompressionDict(identifiers.encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        self.compressor = zstandard.ZstdCompressor(
            level=9, dict_data=prime, write_checksum=False, write_content_size=False, write_dict_id=False
        )

    def marginal(self, context: bytes, candidate: bytes) -> int:
        return len(self.compressor.compress(context + candidate)) - len(self.compressor.compress(context))

    def base(self, text: bytes) -> list[tuple[int, int, int]]:
        """(start, kind, end), bytes; each kind leftmost without overlaps, failing matches dropped."""
        found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST_ASSIGN]
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if len(m[0]) >= LEAST_ACCESS]
        found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
        return sorted(found)

    def novel(self, text: bytes, base: Sequence[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
        found: list[tuple[int, int, int]] = []
        stretches, done = _stretches(text), 0
        fixed = sorted((s, e) for s, _, e in base)
        starts, reached = [s for s, _ in fixed], list(itertools.accumulate((e for _, e in fixed), max))
        measured = list(_candidates(text, stretches))
        taken: list[list[int]] = []          # what is measured itself is no context: keys in a list would teach their alphabet
        for a, b in sorted(measured):
            if taken and a <= taken[-1][1]:
                taken[-1][1] = max(taken[-1][1], b)
            else:
                taken.append([a, b])
        begins = [a for a, _ in taken]

        def around(start: int, end: int, word: bytes) -> bytes:
            out, at = [], start
            for k in range(max(0, bisect.bisect_right(begins, start) - 1), bisect.bisect_left(begins, end)):
                if taken[k][1] > at:
                    out.append(_others(text, at, max(at, taken[k][0]), word))
                    at = taken[k][1]
            return b"".join([*out, _others(text, at, max(at, end), word)])

        for a, b in measured:
            word = text[a:b]
            before = bisect.bisect_left(starts, b)
            if a < done or before and reached[before - 1] > a:
                continue
            context = around(b, min(len(text), b + AROUND), word) + around(max(0, a - AROUND), a, word)
            if self.marginal(context, word) >= _least(word) * len(word):
                found.append((a, 3, b))
                done = b
        return _repeated(text, found, base)

    def candidates(self, raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Numbers of the texts that can hold a span: whole bytes are searched, then only those texts are matched."""
        low, places = LOWER[raw].tobytes(), []
        for word in _SENSITIVE:
            at = low.find(word)
            while at >= 0:
                places.append(at)
                at = low.find(word, at + 1)
        whole = raw.tobytes()
        at = whole.find(b"AKIA")
        while at >= 0:
            places.append(at)
            at = whole.find(b"AKIA", at + 1)
        runs = Words(raw, offsets, _KEY)
        long = np.flatnonzero(runs.ends - runs.starts >= LEAST)
        digits = np.concatenate([[0], np.cumsum(_DIGIT[raw])])
        long = long[digits[runs.ends[long]] > digits[runs.starts[long]]]
        hexes = Words(raw, offsets, _HEX)
        places = np.concatenate([np.array(places, np.int64), runs.starts[long], hexes.starts[hexes.ends - hexes.starts >= 32]])
        return np.unique(np.searchsorted(offsets, places, "right") - 1)

    def tell(self, column: pa.Array) -> list:
        counts: list[list[int]] = [[], [], []]
        digests, every, redacted = [], [], []
        nothing = hashlib.sha256(b"").hexdigest()
        for first, end, raw, offsets in slices(column):
            some = set(self.candidates(raw, offsets).tolist())
            for k in range(end - first):
                base, spans, text = [], [], b""
                if k in some:
                    text = raw[offsets[k] : offsets[k + 1]].tobytes()
                    base = self.base(text)
                    spans = sorted(base + self.novel(text, base))
                for kind in range(3):
                    counts[kind].append(sum(s[1] == kind for s in base))
                digests.append(hashlib.sha256(_listed(text, base).encode()).hexdigest() if base else nothing)
                every.append(_listed(text, spans))
                redacted.append(_redacted(text, spans) if spans else None)
        return [*(pa.array(c, pa.int64()) for c in counts), pa.array(digests, pa.string()), pa.array(every, pa.string()), pa.array(redacted, pa.string())]


def _least(word: bytes) -> float:
    return next((least for of, least in ALPHABETS if of.fullmatch(word)), NOVELTY)


def _mixed(word: bytes) -> bool:
    return bool(re.search(rb"[0-9]", word) and re.search(rb"[A-Za-z]", word))


def _goes_on(line: bytes) -> bool:
    """Whether a line after a sensitive one belongs to it: one run of key characters alone, or a candidate."""
    core = line.strip(EDGES)
    core = core[m.end() :] if (m := MARK.match(core)) else core
    return bool(RUN.fullmatch(core)) or any(_mixed(m[0]) for m in CANDIDATE.finditer(line))


def _candidates(text: bytes, stretches: Sequence[tuple[int, int, bool]]) -> Iterator[tuple[int, int]]:
    """Bounds of what is measured, in order: whole values first, then the long runs inside of them."""
    k = 0
    for m in VALUE.finditer(text):
        a, value = m.start(), m[0].rstrip(b".!?")
        while k < len(stretches) and stretches[k][1] <= a:
            k += 1
        inside = k < len(stretches) and stretches[k][0] <= a
        before = text[max(0, a - BEFORE) : a]
        direct = DIRECT.search(before)
        assigned = ASSIGNED.search(before)
        strong = direct and assigned or (direct or inside and stretches[k][2]) and (not PLAIN.fullmatch(value) or UNSAID.search(value))
        if strong and len(value) >= LEAST and b"-----" not in value and not ORDINARY.fullmatch(value):
            yield a, a + len(value)
        weak = inside or SENSITIVE.search(before) or assigned
        for run in CANDIDATE.finditer(text, a, m.end()) if len(value) >= 16 else ():
            if _mixed(run[0]) and not ORDINARY.fullmatch(run[0]):
                near = text[max(0, run.start() - BEFORE) : run.start()]
                if weak or k < len(stretches) and stretches[k][0] <= run.start() or SENSITIVE.search(near):
                    yield run.span()
        if assigned and not value.startswith(b"//") and (short := SHORT.match(value)) and _mixed(short[0]) and not ORDINARY.fullmatch(value):
            yield a, a + short.end()


def _stretches(text: bytes) -> list[tuple[int, int, bool]]:
    """Sensitive parts: lines from their first sensitive word on, the lines that go on from there, and (true) blocks up to END."""
    out, going, heading, block, before = [], False, False, False, 0
    last = text.rfind(END)
    for m in LINE.finditer(text):
        start, end = m.span()
        line = m[0].strip()
        if block:
            out.append((start, end, True))
            block = END not in line
            continue
        if not line:
            continue
        # Empty lines end what goes on, but not directly after a heading.
        going = going and (start <= before + 1 or heading) and _goes_on(line)
        before, heading = end, line.endswith(b":")
        word = SENSITIVE.search(text, start, end)
        if going:
            out.append((start, end, False))
        elif word:
            out.append((word.end(), end, False))
            going = True
        if word and last >= end and BEGIN.search(line):
            block, going = END not in line, False
    return out


def _others(text: bytes, start: int, end: int, word: bytes) -> bytes:
    """The bytes from ``start`` to ``end`` without what is a copy of the word or of a long part of it."""
    size, end = min(SHARED, len(word)), min(end, len(text))
    out, at = [], start
    for k in range(max(0, start - size + 1), end):
        if text[k : k + size] in word and k + size <= len(text):
            out.append(text[at : max(at, k)])
            at = max(at, k + size)
    return b"".join([*out, text[at : max(at, end)]])


def _repeated(text: bytes, found: list[tuple[int, int, int]], base: Sequence[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """The found spans and every other place of their strings, also inside longer runs; none inside of another."""
    if not found:
        return found
    words = {text[a:b] for a, _, b in found}
    lengths: dict[int, set[int]] = {}
    for w in words:
        lengths.setdefault(int.from_bytes(w[:8], "little"), set()).add(len(w))
    raw = np.frombuffer(text, np.uint8).astype(np.uint64)
    first = np.zeros(len(raw) - 7, np.uint64)
    for k in range(8):
        first |= raw[k : k + len(first)] << np.uint64(8 * k)
    places = np.flatnonzero(np.isin(first, np.array(list(lengths), np.uint64)))
    spans = {(a, b) for a, _, b in found}
    for at in places.tolist():
        spans |= {(at, at + n) for n in lengths[int(first[at])] if text[at : at + n] in words}
    # The longest first where several start; what lies inside an earlier span or meets a fixed pattern is left out.
    out: list[tuple[int, int, int]] = []
    fixed, k, reached, last = sorted((s, e) for s, _, e in base), 0, 0, 0
    for a, b in sorted(spans, key=lambda s: (s[0], -s[1])):
        while k < len(fixed) and fixed[k][0] < b:
            reached = max(reached, fixed[k][1])
            k += 1
        if b > last and a >= reached:
            out.append((a, 3, b))
            last = b
    return out


def _listed(text: bytes, spans: Sequence[tuple[int, int, int]]) -> str:
    """kind:start:end in code points."""
    out, byte, point = [], 0, 0
    for a, kind, b in spans:
        point += len(text[byte:a].decode()) if a >= byte else -len(text[a:byte].decode())
        byte = a
        out.append(f"{KINDS[kind]}:{point}:{point + b - a}")      # spans are ASCII
    return ",".join(out)


def _redacted(text: bytes, spans: Sequence[tuple[int, int, int]]) -> str:
    out, at = [], 0
    for a, kind, b in spans:
        if b > at:
            out += [text[at : max(a, at)], f"<{KINDS[kind]}>".encode() if a >= at else b""]
            at = b
    return b"".join([*out, text[at:]]).decode()


@own_names("text")
def secret_spans(docs: DataFrame, text: str = "text", carry: Sequence[str] | None = None) -> DataFrame:
    """The carried columns, counts of the fixed kinds, their digest, all spans, and the text with spans masked.

    ``redacted`` is null where nothing was found.  Null and empty texts have no spans; offsets are code
    points, ends exclusive.  Copies of a candidate do not make it known: they are left out of its context,
    and each place of a string found novel is reported.
    """
    return text_results(docs, FIELDS, lambda: Scanner().tell, text, carry)
