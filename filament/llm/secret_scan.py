"""Operator 1, secret scans: assignment-aware lexing.

Three base patterns (``assign``, ``access``, ``hex``) are found leftmost and
non-overlapping, each kind on its own.  On top of them the text is lexed as source or
configuration syntax into name-literal pairs (``name = "x"``, ``"name": 'x'``,
``export NAME=x``, ``name: x``, ``name := x``, ``table["name"] = "x"``, ``name: type = "x"``, ``ENV NAME x``,
``<name>x</name>``; literals also in triple quotes, or joined by ``+``); identifiers and
``${...}`` references on a right-hand side (``{...}`` in an f-string) are replaced by the literal that was last
assigned to them, and each literal is scored by how sensitive its target's name is and how
much it looks like a random value.  Names that say little (``key``, ``signature``, ``salt``) count only with a long random
value; blanks may stand in a passphrase only.  Literals that score at least ``THRESHOLD`` become
spans of kind ``lexed`` (the span is the literal itself, where it stands).  Scopes aren't told apart: the last assignment
above a use counts.

A joined constant is a node that refers to its parts and holds what the score needs (character counts), so texts that
double a constant line by line cost a step a line; a part's spans are reported once.

Defined results: a null text counts as empty; an empty text has no spans; every row gives
one row, also repeated ids and null ids; other columns are not read.  Offsets are code
points, ends exclusive.  Whole texts are scanned.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter

from pyspark.sql import DataFrame

from .common import arrow_map

KINDS = ("assign", "access", "hex", "lexed")
THRESHOLD = 0.5

# fixed values: the base patterns of the contract
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ASSIGN_STEMS = ("passw", "secret", "token", "api")
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")  # a match of AKIA[A-Z0-9]+ with 20 or more characters
HEX = re.compile(r"[0-9a-f]{24,}")

#: how strongly part of a name speaks for a secret value
NAME_WEIGHTS = {
    "password": 1.0, "passwd": 1.0, "pwd": 0.9, "pw": 0.9, "passphrase": 1.0, "secret": 1.0, "token": 0.9, "apikey": 0.9,
    "credential": 0.9, "credentials": 0.9, "privatekey": 1.0, "accesskey": 0.9, "secretkey": 1.0, "authkey": 0.9,
    "encryptionkey": 0.9, "signingkey": 0.9, "sshkey": 0.9, "masterkey": 0.9, "storagekey": 0.9,
    "bearer": 0.8, "auth": 0.6, "key": 0.4, "salt": 0.4, "signature": 0.4,
}
#: what a weight under ``THRESHOLD`` becomes beside a literal that looks random
LIFTED = 0.6
#: characters from which a literal can look random
RANDOM_LENGTH = 16
LEX_STEMS = ("pass", "pw", "secret", "token", "key", "credential", "auth", "bearer", "salt", "signature")
LEX_SIGNS = ("=", ":", "ENV", "ARG", "</")
NEGATIVE = frozenset("file path url uri name id length size count type public hint field label column".split())
PLACEHOLDER = re.compile(r"(?i)^(?:<.*>|\*+|x+|\.+|changeme|example|placeholder|none|null|true|false|your[\W_].*|test)$")
PAIR = re.compile(r"""
    (?m:^)[ \t]*+(?:ENV|ARG)[ \t]++(?P<env>[A-Za-z_]\w*+)[ \t]++(?!=)
  | \[[ \t]*+(?P<q>["'])(?P<item>[A-Za-z_][\w.\-]*+)(?P=q)[ \t]*+\][ \t]*+=(?!=)[ \t]*+
  | <(?P<tag>[A-Za-z_][\w.\-]*+)>[ \t]*+
  | (?<![\w.\-])(?P<p>["']?)(?P<name>[A-Za-z_][\w.\-]*+)(?P=p)[ \t]*+
    (?: :[ \t]*+[A-Za-z_][\w.<>\[\]|?]*+[ \t]++=(?!=) | := | => | =(?!=) | :(?![:/]) )[ \t]*+
""", re.A | re.X)
QUOTED = re.compile(r"""
    (?P<prefix>[fFrRbBuU]{0,2})
    (?: \"{3}([^"]*+(?:"(?!"")[^"]*+)*+)\"{3} | '{3}([^']*+(?:'(?!'')[^']*+)*+)'{3}
      | "((?:[^"\\\n]|\\.)*+)" | '((?:[^'\\\n]|\\.)*+)' | `([^`\n]*+)` )
""", re.X)
ELEMENT = re.compile(r"[^<\n]++(?=</)")
REF = re.compile(r"\$\{([\w.\-]+)\}|\$([A-Za-z_]\w*)|\{\{\s*([\w.\-]+)\s*\}\}", re.A)
FIELD = re.compile(r"(?<!\{)\{([A-Za-z_][\w.]*)[!:}]", re.A)
BARE = re.compile(r"""[^\s"'`,;#<>(){}\[\]$]+""")
JOIN = re.compile(r"[ \t]*\+[ \t]*")
NAME_PART = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|\d+")
#: a joined constant's counts are scaled down beyond this length: only proportions matter there
LONG = 2.0 ** 40


def name_parts(name: str) -> list[str]:
    """Lower-case words of an identifier (snake, dotted, camel case), after its last dot."""
    return [p.lower() for p in NAME_PART.findall(name.rpartition(".")[2])]


def name_score(name: str) -> float:
    """0..1: the weight of the most telling part of an identifier."""
    parts = name_parts(name)
    if parts and parts[-1] in NEGATIVE:
        return 0.0
    pairs = parts + [a + b for a, b in zip(parts, parts[1:])]
    return max((NAME_WEIGHTS.get(p, 0.0) for p in pairs), default=0.0)


class Constant:
    """What a name stands for: a literal in the text, or literals and constants joined (``parts``).

    ``n`` characters, ``counts`` of them by code point (beyond ASCII by code point modulo 128, so that a
    constant's size is bounded); ``head`` and ``last`` tell placeholders.
    """

    __slots__ = ("n", "counts", "head", "last", "parts", "span", "told")

    def __init__(self, value: str = "", span: tuple[int, int] | None = None, parts: "list[Constant] | None" = None):
        self.span, self.parts, self.told = span, parts or [], False
        if parts is None:
            self.n, self.head, self.last, self.counts = float(len(value)), value[:16], value[-1:], None
            self.parts = value
            return
        self.n = sum(p.n for p in parts)
        self.head, self.last, self.counts = "", "", Counter()
        for p in parts:
            self.head = (self.head + p.head)[:16] if len(self.head) < 16 else self.head
            self.last = p.last or self.last
            self.counts.update(p.characters())
        if self.n > LONG:
            self.counts = Counter({c: k * (LONG / self.n) for c, k in self.counts.items()})
            self.n = LONG

    def characters(self) -> Counter:
        if self.counts is None:
            self.counts = Counter()
            for c, k in Counter(self.parts).items():
                o = ord(c)
                # white space beyond ASCII counts as a space
                self.counts[32 if c.isspace() else o if o < 128 else 128 + o % 128] += k
        return self.counts

    def placeholder(self) -> bool:
        if self.n <= 16:
            return bool(PLACEHOLDER.match(self.head))
        if len(self.characters()) <= 2 and {chr(c).lower() for c in self.counts} in ({"*"}, {"x"}, {"."}):
            return True
        return self.head[0] == "<" and self.last == ">" or bool(re.match(r"(?i)your[\W_]", self.head))

    def spans(self) -> list[tuple[int, int]]:
        """The literals it is made of, but those told before."""
        out, todo = [], [self]
        while todo:
            c = todo.pop()
            if not c.told:
                c.told = True
                if c.span:
                    out.append(c.span)
                else:
                    todo += c.parts
        return out


def literal_score(value: "Constant | str", blanks: bool = False) -> float:
    """0..1: length, entropy and mixture of character classes; placeholders score 0, and so do texts with
    white space unless ``blanks`` may stand in them."""
    v = Constant(value) if isinstance(value, str) else value
    if v.n < 6 or v.placeholder():
        return 0.0
    counts = v.characters()
    if not blanks and any(chr(c).isspace() for c in counts if c < 128):
        return 0.0
    entropy = -sum(k / v.n * math.log2(k / v.n) for k in counts.values())
    return min(1.0, entropy / 3.5) * min(1.0, v.n / 10) * (1.0 if _classes(counts) >= 2 else 0.4)


def _classes(counts: Counter) -> int:
    """Digits, lower case, upper case and others; letters beyond ASCII count as lower case."""
    return len({"d" if 48 <= c <= 57 else "u" if 65 <= c <= 90 else "l" if 97 <= c <= 122 or c >= 128 else "o" for c in counts})


def looks_random(v: Constant) -> bool:
    """Long, of many characters, and letters and digits mixed."""
    counts = v.characters()
    digits = sum(k for c, k in counts.items() if 48 <= c <= 57)
    return v.n >= RANDOM_LENGTH and literal_score(v) == 1.0 and 0.1 * v.n <= digits < v.n


def secret_score(name: str, value: Constant) -> float:
    weight = name_score(name)
    if not weight:
        return 0.0
    score = literal_score(value, blanks="passphrase" in name_parts(name))
    if weight < THRESHOLD and score == 1.0 and looks_random(value):
        weight = LIFTED
    return weight * score


def lex_pairs(text: str):
    """Yields ``(name, constant)``: what reaches each target, with constants propagated in order of assignment."""
    known: dict[str, Constant] = {}
    for m in PAIR.finditer(text):
        pos, parts = m.end(), []
        if m["tag"]:
            if e := ELEMENT.match(text, pos):
                value = e.group().rstrip()
                if value:
                    yield m["tag"], Constant(value, (pos, pos + len(value)))
            continue
        while True:
            if q := QUOTED.match(text, pos):
                g = q.lastindex
                inner, pos = q.group(g), q.end()
                names = [next(filter(None, r.groups())) for r in REF.finditer(inner)]
                if "f" in q["prefix"].lower():
                    names += [r[1] for r in FIELD.finditer(inner)]
                refs = [known[n] for n in names if n in known]
                parts += refs or ([Constant(inner, q.span(g))] if inner else [])
            elif r := REF.match(text, pos):
                parts += [known[n] for n in [next(filter(None, r.groups()))] if n in known]
                pos = r.end()
            elif b := BARE.match(text, pos):
                word = b.group().rstrip(".")
                parts += [known[word]] if word in known else [Constant(word, (b.start(), b.start() + len(word)))] if word else []
                pos = b.end()
            else:
                break
            if not (j := JOIN.match(text, pos)):
                break
            pos = j.end()
        if parts:
            name = m["name"] or m["item"] or m["env"]
            known[name] = parts[0] if len(parts) == 1 else Constant(parts=parts)
            yield name, known[name]


def find_spans(text: str | None) -> list[tuple[int, int, int]]:
    """All spans as ``(start, kind index, end)``, sorted by start and then kind as listed."""
    if not text:
        return []
    out = []
    lower = text.lower()
    if any(s in lower for s in ASSIGN_STEMS):
        out += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
    out += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    if any(s in text for s in LEX_SIGNS) and any(s in lower for s in LEX_STEMS):
        lexed = set()
        for name, value in lex_pairs(text):
            if secret_score(name, value) >= THRESHOLD:
                lexed.update((a, 3, b) for a, b in value.spans())
        out += lexed
    return sorted(out)


def redact(text: str | None, mark: str = "[SECRET]") -> str | None:
    """The text with every (merged) span replaced by ``mark``."""
    spans = find_spans(text)
    if not spans:
        return text
    out, at, upto = [], 0, -1
    for start, _, end in spans:
        if start < upto:  # inside or overlapping the span before
            at = upto = max(upto, end)
            continue
        out += [text[at:start], mark]
        at = upto = end
    return "".join(out) + text[at:]


def scan_secrets(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: the id, counts of the base kinds and every span as a struct."""
    schema = f"{id_col} {df.schema[id_col].dataType.simpleString()}, n_assign long, n_access long, n_hex long, " \
             "spans array<struct<kind:string,start:long,end:long>>"

    def run(batches):
        for b in batches:
            found = [find_spans(t) for t in b.column(1).to_pylist()]
            yield {
                id_col: b.column(0),
                **{f"n_{k}": [sum(s[1] == i for s in f) for f in found] for i, k in enumerate(KINDS[:3])},
                "spans": [[{"kind": KINDS[k], "start": a, "end": e} for a, k, e in f] for f in found],
            }

    return arrow_map(df.select(id_col, text_col), run, schema)


def redact_secrets(df: DataFrame, text_col: str = "text", mark: str = "[SECRET]") -> DataFrame:
    """All columns of ``df``, the text with its secrets replaced (null stays null)."""
    names, i = df.columns, df.columns.index(text_col)

    def run(batches):
        for b in batches:
            yield {n: (b.column(k) if k != i else [redact(t, mark) for t in b.column(k).to_pylist()])
                   for k, n in enumerate(names)}

    return arrow_map(df, run, df.schema)


def digest(spans: list[dict]) -> str:
    return hashlib.sha256(",".join(f"{s['kind']}:{s['start']}:{s['end']}" for s in spans).encode()).hexdigest()
