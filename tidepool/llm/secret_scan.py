"""Secrets in texts: fixed patterns, and credential values that would take many guesses.

The base patterns find assignments, access keys and long hexadecimal runs.
Beyond them, every value in a credential context ("pwd: x", "passphrase is x",
"Bearer x", "user:x@host" in a URL) is judged by how many guesses it would take. The cost is the
minimum over all segmentations of the value into dictionary words, dates,
repeats, keyboard walks and brute-force spans (after Wheeler, "zxcvbn:
Low-Budget Password Strength Estimation", 2016), found by dynamic
programming in time linear in the value's length, repeats of long blocks included but for the few that may be cheapest.
Values whose cost reaches the threshold are reported as spans of kind ``guess``, unless they are code that
fetches a value or, by the statistics of their letters, words of a language.

The dictionary is fixed, so what a text yields does not depend on the texts it is scanned with.
"""

from __future__ import annotations

import functools
import math
import pkgutil
import re
import unicodedata
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidepool.llm.textio import parts, utf8

# The base patterns and the shortest value or match that counts.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE)
ACCESS = re.compile(r"AKIA[A-Z0-9]{12,}")
HEX = re.compile(r"[0-9a-f]{32,}")
SHORTEST_ASSIGN = 8
KINDS = ("assign", "access", "hex", "guess")

#: Words before a value that make it a credential. Longest first: the first that fits is taken.
CONTEXT_WORDS = ("passphrase", "passcode", "password", "passwd", "pass", "pwd", "pin", "credential", "credentials", "secret", "private_key",
                 "access_key", "secret_key", "auth_token", "access_token", "client_secret", "apikey", "api_key", "api-key", "token")
#: Those that also count with letters or digits glued in front (authtoken, mysqlpwd), and what may be glued before the short ones.
_GLUED = tuple(w for w in CONTEXT_WORDS if w not in ("pass", "pin"))
_BEFORE_SHORT = ("admin", "api", "app", "auth", "db", "dev", "email", "ftp", "host", "http", "imap", "jdbc", "key", "keystore", "ldap", "login", "mail", "mongo",
                 "my", "mysql", "new", "old", "pg", "postgres", "prod", "proxy", "redis", "root", "sa", "smtp", "sql", "ssh", "store", "sudo", "super", "svc", "sys",
                 "test", "truststore", "user", "usr", "vpn", "wifi", "wlan")
_any = lambda words: "(?:" + "|".join(sorted(map(re.escape, words), key=len, reverse=True)) + ")"
_START = r"(?:(?<![A-Za-z0-9])|(?-i:(?<=[a-z0-9])(?=[A-Z])))"  # of a word, or of a part of it at a change of case
_NAME = rf"(?:{_any(_GLUED)}|{_START}(?:{_any(_BEFORE_SHORT)}?pass|pin))(?![A-Za-z0-9])"
_AFTER = r"""["']?[ \t]*(?:[:=]{1,2}|=>|\bis\b)[ \t]*"""
# A quoted value runs to the closing quote on its line; a backslash takes the next character along.
CONTEXT = re.compile(
    rf"""(?:{_NAME}{_AFTER}|(?<![A-Za-z0-9])bearer[ \t]+)"""
    r"""(?:"((?:[^"\\\r\n]|\\[^\r\n]){6,})"|'((?:[^'\\\r\n]|\\[^\r\n]){6,})'|([^\s"'<>,;]{6,}))""", re.ASCII | re.IGNORECASE)
URL = re.compile(r"""[a-z][a-z0-9+.-]{1,20}://[^\s:/@"'<>]*:([^\s/@"'<>]{6,})@""", re.ASCII | re.IGNORECASE)
_HINTS = tuple(sorted({"pass", "pwd", "pin", "credential", "secret", "token", "key", "bearer"}))

#: log10 of the guesses from which a value counts as a secret.
THRESHOLD = 9.0
#: Common words of passwords in order of how often they are guessed.
PASSWORDS = tuple("""password admin root user login welcome letmein master secret test guest changeme default qwerty dragon monkey
shadow sunshine princess football baseball superman batman trustno starwars hello love money summer winter spring autumn monday friday
january february march april june july august september october november december the and for you that this with have from
your what when time work home computer internet server system access token key pass word example sample dummy placeholder foobar
company office service account test123 public private none null true false todo""".split())
#: General words, most common first: the whole words among the tokens of three public BPE vocabularies, in the order of their merges.
GENERAL = tuple(pkgutil.get_data("tidepool.llm", "words.txt").decode().split())
#: The dictionary of a scan; a parameter where a larger list is at hand.
WORDS = tuple(dict.fromkeys(PASSWORDS + GENERAL))
#: Mean log10 probability of a letter after the one before from which letters count as a word: of random letters one in twenty
#: reaches it, of the general words of 6 letters or more 97 in a hundred; and the longest word that stands behind a colon or an equals sign.
WORDLIKE, LONGEST_WORD = -1.5, 20
# Rows of common keyboards; a walk runs along one of them in either direction.
KEYBOARD = ("`1234567890-=", "qwertyuiop[]\\", "asdfghjkl;'", "zxcvbnm,./", "~!@#$%^&*()_+", "qwertzuiop", "yxcvbnm", "azertyuiop", "abcdefghijklmnopqrstuvwxyz")
LEET = str.maketrans("4@310$5+7", "aaeiosstt")
BRUTE = {"digit": 1.0, "lower": math.log10(26), "upper": math.log10(26), "other": math.log10(33)}
#: What each further segment adds: an attacker does not know how many there are.
SEGMENT = 1.0
_DATE = re.compile(r"(?:19|20)\d\d([-/._]?)(?:0?[1-9]|1[0-2])\1(?:0?[1-9]|[12]\d|3[01])|(?:0?[1-9]|[12]\d|3[01])([-/._]?)(?:0?[1-9]|1[0-2])\2(?:19|20)?\d\d|(?:19|20)\d\d", re.ASCII)


# -- guess cost -----------------------------------------------------------------------------------

def _class(c: str) -> str:
    return "digit" if "0" <= c <= "9" else "lower" if "a" <= c <= "z" else "upper" if "A" <= c <= "Z" else "other"


class Words:
    """Ranks of dictionary words, the best of all dictionaries, and the rules of their variants."""

    def __init__(self, words: tuple[str, ...] = WORDS, *more: tuple[str, ...]):
        self.rank: dict[str, int] = {}
        for ranked in (words, *more):
            for i, w in enumerate(ranked, 1):
                self.rank[w.lower()] = min(i, self.rank.get(w.lower(), i))
        self.longest = max(map(len, self.rank), default=0)
        self.starts = {w[:k] for w in self.rank for k in range(3, len(w) + 1)}  # of words, and of words reversed
        self.ends = {w[::-1][:k] for w in self.rank for k in range(3, len(w) + 1)}

    def reach(self, low: str, leet: str, i: int) -> int:
        """Where the longest span from ``i`` ends that may still be a word or a reversed one."""
        j = min(len(low), i + self.longest)
        most = i + 2
        for of, known in ((low, self.starts), (leet, self.starts), (low, self.ends)):
            k = i + 3
            while k <= j and of[i:k] in known:
                k += 1
            most = max(most, k - 1)
        return most

    def cost(self, part: str) -> float | None:
        """log10 guesses of a span as one dictionary word, in any case, reversed or with digits for letters."""
        low = part.lower()
        best = None
        for extra, w in ((0.0, low), (0.31, low[::-1]), (0.31, low.translate(LEET))):
            if w in self.rank:
                c = math.log10(self.rank[w] + 1) + extra
                best = c if best is None else min(best, c)
        if best is None:
            return None
        uppers = sum(c.isupper() for c in part)
        return best + (0 if not uppers else 0.31 if uppers == len(part) or part[0].isupper() and uppers == 1 else math.log10(2 + math.comb(len(part), uppers)))


@functools.lru_cache(maxsize=2)
def dictionary(words: tuple[str, ...]) -> Words:
    """The same for all tasks of a Python worker."""
    return Words(words)


def fixed_spans(value: str, words: Words) -> Iterator[tuple[int, int, float, str]]:
    """(start, end, log10 guesses, kind) of the words, dates and walks in a value; any 3 or more keys of a walk are one."""
    n = len(value)
    low = value.lower()
    if len(low) != n:  # a letter whose lower case has two
        low = "".join(c.lower() if len(c.lower()) == 1 else c for c in value)
    leet = low.translate(LEET)
    for i in range(n):
        for j in range(i + 3, words.reach(low, leet, i) + 1):
            c = words.cost(value[i:j])
            if c is not None:
                yield i, j, c, "word"
        m = _DATE.match(value, i)
        if m:
            yield i, m.end(), math.log10(365 * 120) + (0.6 if m[1] or m[2] else 0) if m.end() - i > 4 else math.log10(120), "date"
    for row in KEYBOARD:
        place = {c: k for k, c in enumerate(row)}
        i = 0
        while i < n - 1:
            a, b = place.get(low[i]), place.get(low[i + 1])
            if a is None or b is None or abs(a - b) != 1:
                i += 1
                continue
            j, d = i + 2, b - a
            while j < n and low[j] in place and place[low[j]] - place[low[j - 1]] == d:
                j += 1
            for s in range(i, j - 2):  # a walk is no longer than its row
                for e in range(s + 3, j + 1):
                    yield s, e, math.log10(len(KEYBOARD) * 2 * len(row)) + math.log10(e - s), "walk"
            i = j - 1


def _same(value: str, a: int, b: int, step: int) -> int:
    """How many characters agree from ``a`` and ``b`` > a on, forwards or (step -1) ending there."""
    most = len(value) - b if step > 0 else a + 1
    if most <= 0 or value[a] != value[b]:
        return 0
    part = (lambda at, k: value[at: at + k]) if step > 0 else (lambda at, k: value[at + 1 - k: at + 1])
    low, k = 1, 2
    while k <= most and part(a, k) == part(b, k):
        low, k = k, 2 * k
    high = min(k - 1, most)
    while low < high:
        k = (low + high + 1) // 2
        low, high = (k, high) if part(a, k) == part(b, k) else (low, k - 1)
    return low


def repeated(value: str) -> list[tuple[int, int, int]]:
    """(period, start, end) of the maximal runs of a block, at least two blocks long; the block is no repeat itself.

    A run of period p holds two neighbouring multiples of p, so n / p
    comparisons find all runs of the period (after Main and Lorentz, 1984).
    """
    n = len(value)
    out: list[tuple[int, int, int]] = []
    active: list[tuple[int, int, int]] = []
    for p in range(1, n // 2 + 1):
        active = [r for r in active if r[2] - r[1] >= 2 * p]
        finer = [r for r in active if p % r[0] == 0]
        at = 0
        while at + p < n:
            inside = next((r for r in finer if r[1] <= at and at + 2 * p <= r[2]), None)
            if inside:
                at = max(at + p, (inside[2] - p) // p * p)
                continue
            if value[at] == value[at + p]:
                start = at - _same(value, at - 1, at + p - 1, -1) if at else 0
                end = at + p + _same(value, at, at + p, 1)
                if end - start >= 2 * p:
                    if not any(r[1] <= start and end <= r[2] for r in finer):
                        out.append((p, start, end))
                        active.append(out[-1])
                    at = max(at + p, (end - p) // p * p)
                    continue
            at += p
    return list(dict.fromkeys(out))


def least_repeats(period: int) -> int:
    return 3 if period == 1 else 2


def spans(value: str, words: Words) -> Iterator[tuple[int, int, float, str]]:
    """The fixed spans of a value and its repeats of one character: quadratic in a repeat's length, for looking at only."""
    yield from fixed_spans(value, words)
    for _, s, e in _single(value):
        for i in range(s, e - 2):
            for j in range(i + 3, e + 1):
                yield i, j, BRUTE[_class(value[s])] + math.log10(j - i), "repeat"


class _Run:
    """The cheapest last repeat at each position of one run of blocks, over all starts and counts.

    Blocks that start a multiple of the period apart are the same. A start is dropped as
    soon as an earlier one with the same block is as cheap: the earlier one's cost grows more slowly.
    """

    def __init__(self, period: int, start: int, end: int):
        self.period, self.start, self.end = period, start, end
        self.least = least_repeats(period) * period
        self.starts: dict[int, list[tuple[int, float]]] = {}
        self.block: dict[int, float] = {}

    def cheapest(self, j: int, free: list[float], block_cost, wanted) -> float:
        """For the repeats that end at ``j``, where ``free`` is known before it; blocks that aren't ``wanted`` are passed over."""
        i = j - self.least
        if i < self.start:
            return math.inf
        r = (i - self.start) % self.period
        kept: list[tuple[int, float]] = []
        best = math.inf
        for at, before in (*self.starts.get(r, ()), (i, free[i] + (SEGMENT if i else 0))):
            c = before + math.log10((j - at) // self.period)
            if c < best:
                best = c
                kept.append((at, before))
        self.starts[r] = kept
        if r not in self.block:
            if not any(wanted(self, at, j) for at, _ in kept):
                return math.inf
            self.block[r] = block_cost(i, i + self.period)
        return best + self.block[r]


def guess_cost(value: str, words: Words, blocks: bool = False) -> float:
    """log10 of the guesses for a value: the cheapest segmentation.

    The cost of a segmentation is the sum of its spans' costs plus ``SEGMENT``
    for each span after the first; a brute-force span costs the logarithm of
    its characters' classes, one after the other. A repeat costs its block and
    the logarithm of the repetitions. Blocks are single characters or, with
    ``blocks``, of any length, each costing its own cheapest segmentation.
    """
    return _cheapest(value, words, blocks, {})


def _cheapest(value: str, words: Words, blocks: bool, known: dict[str, float]) -> float:
    """A block may begin anywhere in its run, and each beginning is another block to be segmented. Few can be part of the cheapest
    segmentation: a way that repeats blocks from each run's start alone is an upper bound, and one that charges repeats less
    than they can cost bounds what lies before and behind any other block, which is segmented only if the two leave room."""
    if value in known:
        return known[value]
    n = len(value)
    ending: dict[int, list[tuple[int, float]]] = {}
    for i, j, c, _ in fixed_spans(value, words):
        ending.setdefault(j, []).append((i, c))
    single = [r for r in _single(value) if r[2] - r[1] >= least_repeats(1)]
    longer = [(p, s, e) for p, s, e in repeated(value) if p > 1 and e - s >= 2 * p] if blocks else []
    cost = lambda a, b: BRUTE[_class(value[a])] if b - a == 1 else _cheapest(value[a:b], words, blocks, known)
    plain = _forward(value, ending, single, cost, lambda r, at, j: True)
    if longer:
        below = _bounds(value, ending, single, longer, plain)
        upper = _forward(value, ending, single + longer, cost, lambda r, at, j: r.period == 1 or at == r.start)[n]
        low, behind = below
        # a repeat from ``at`` to ``j`` costs, with all before it, at least what its first block's end does
        room = lambda r, at, j: r.period == 1 or at == r.start or low[at + r.period] + math.log10((j - at) // r.period) + behind[j] < upper
        plain = _forward(value, ending, single + longer, cost, room)
    known[value] = plain[n]
    return plain[n]


def _forward(value: str, ending: dict[int, list[tuple[int, float]]], repeats: list[tuple[int, int, int]], block_cost, wanted) -> list[float]:
    """Cheapest cost of each prefix, of the ways that use only repeats that are ``wanted``."""
    n = len(value)
    runs: dict[int, list[_Run]] = {}  # by the first position where one of their repeats can end
    for p, s, e in repeats:
        runs.setdefault(s + least_repeats(p) * p, []).append(_Run(p, s, e))
    active: list[_Run] = []
    free = [math.inf] * (n + 1)  # cheapest way to each position, any last span
    brute = [math.inf] * (n + 1)  # the same with a brute-force span last
    free[0] = 0.0
    for j in range(1, n + 1):
        step = BRUTE[_class(value[j - 1])]
        brute[j] = min(brute[j - 1], free[j - 1] + (SEGMENT if j > 1 else 0)) + step
        active = [r for r in active if r.end >= j] + runs.get(j, [])
        free[j] = min([brute[j], *[free[i] + (SEGMENT if i else 0) + c for i, c in ending.get(j, ())], *[r.cheapest(j, free, block_cost, wanted) for r in active]])
    return free


def _bounds(value: str, ending: dict[int, list[tuple[int, float]]], single: list[tuple[int, int, int]], longer: list[tuple[int, int, int]],
            plain: list[float]) -> tuple[list[float], list[float]]:
    """(no prefix costs less, no suffix with the ``SEGMENT`` ahead of it costs less), where repeats of longer blocks are charged too little.

    Without repeats in it, a block costs at least the difference of the ``plain`` costs of the prefixes it ends and begins at,
    less a segment; with some, at least nothing.
    """
    n = len(value)
    runs = []
    for p, s, e in longer:
        nested = any(q < p and min(e, f) - max(s, t) >= 2 * q for q, t, f in longer)
        least = [0.0 if nested else max(0.0, plain[i + p] - plain[i] - SEGMENT) for i in range(s, e - 2 * p + 1)]
        runs.append((p, s, e, least))
    begin: dict[int, list[int]] = {}
    for k, (p, s, e, _) in enumerate(runs):
        begin.setdefault(s + 2 * p, []).append(k)
    ones: dict[int, float] = {}
    low, brute, cheapest, active = [0.0] + [math.inf] * n, math.inf, {}, []
    by_end = {j: s for _, s, e in single for j in range(s + 3, e + 1)}
    for j in range(1, n + 1):
        step = BRUTE[_class(value[j - 1])]
        brute = min(brute, low[j - 1] + (SEGMENT if j > 1 else 0)) + step
        active = [k for k in active if runs[k][2] >= j] + begin.get(j, [])
        best = min([brute, *[low[i] + (SEGMENT if i else 0) + c for i, c in ending.get(j, ())]])
        if j in by_end:
            best = min(best, _one(low, by_end[j], j, ones) + step)
        for k in active:
            p, s, _, least = runs[k]
            i = j - 2 * p
            cheapest[k] = min(cheapest.get(k, math.inf), low[i] + (SEGMENT if i else 0) + least[i - s])
            best = min(best, cheapest[k] + math.log10(2))
        low[j] = best
    behind, brute, cheapest, active = [math.inf] * n + [0.0], math.inf, {}, []
    starting: dict[int, list[tuple[int, float]]] = {}
    for j, spans_ in ending.items():
        for i, c in spans_:
            starting.setdefault(i, []).append((j, c))
    finish: dict[int, list[int]] = {}
    for k, (p, s, e, _) in enumerate(runs):
        finish.setdefault(e - 2 * p, []).append(k)
    by_start = {i: e for _, s, e in single for i in range(s, e - 2)}
    ahead: dict[int, float] = {}
    for i in range(n - 1, -1, -1):
        step = BRUTE[_class(value[i])]
        brute = min(brute, behind[i + 1]) + step
        active = [k for k in active if runs[k][1] <= i] + finish.get(i, [])
        best = min([brute, *[behind[j] + c for j, c in starting.get(i, ())]])
        if i in by_start:
            e = by_start[i]
            ahead[e] = min(ahead.get(e, math.inf), behind[i + 3])
            best = min(best, ahead[e] + step)
        for k in active:
            p, s, _, least = runs[k]
            cheapest[k] = min(cheapest.get(k, math.inf), behind[i + 2 * p])
            best = min(best, cheapest[k] + least[i - s] + math.log10(2))
        behind[i] = best + SEGMENT
    return low, behind


def _one(low: list[float], start: int, j: int, held: dict) -> float:
    """The least cost before a repeat of one character that ends at ``j``, its run beginning at ``start``."""
    i = j - 3
    held[start] = min(held.get(start, math.inf), low[i] + (SEGMENT if i else 0))
    return held[start]


def _single(value: str) -> list[tuple[int, int, int]]:
    """The runs of one character among ``repeated``, in linear time."""
    return [(1, *m.span()) for m in re.finditer(r"(.)\1+", value, re.DOTALL)]


# -- finding --------------------------------------------------------------------------------------

def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the base patterns, by start, then kind as listed. Positions are code points."""
    found = []
    low = text.lower() if text.isascii() else text.encode().lower().decode()
    if any(w in low for w in ("passw", "secret", "token", "api")):
        found += [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= SHORTEST_ASSIGN]
    if "AKIA" in text:
        found += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text)]
    found += [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]
    return sorted(found, key=lambda s: (s[0], KINDS.index(s[2])))


def _values(text: str) -> list[tuple[int, int, str]]:
    """(start, end, what stands before) of the values in a credential context, in order, without overlaps:
    'quote', 'is', 'sign' or 'other'."""
    low = text.encode().lower().decode()
    found = []
    if any(h in low for h in _HINTS):
        for m in CONTEXT.finditer(text):
            group = next(g for g in (1, 2, 3) if m[g] is not None)
            before = text[m.start(): m.start(group)].rstrip(" \t")
            found.append((*m.span(group), "quote" if group < 3 else "is" if before[-2:].lower() == "is" else "sign" if before[-1:] in ":=>" else "other"))
    if "://" in text and "@" in text:
        found += [(*m.span(1), "other") for m in URL.finditer(text)]
    out: list[tuple[int, int, str]] = []
    for s in sorted(found):
        if not out or s[0] >= out[-1][1]:
            out.append(s)
    return out


def credential_values(text: str) -> list[tuple[int, int]]:
    """Spans of the values in a credential context, in order, without overlaps of their own."""
    return [(a, b) for a, b, _ in _values(text)]


#: Code that fetches a value: a call, an index, a variable of a shell or a template, a path of names.
_CODE = re.compile(r"[A-Za-z_][\w.]*[(\[]|\$\{|\$[A-Za-z_]\w*$|\$\(|\{\{|%\(|[A-Za-z_]+(?:\.[A-Za-z_]+)+$|<[A-Za-z]")


@functools.cache
def _letter_pairs() -> tuple[Counter, Counter]:
    """How often a letter follows another in the general words, and how often it comes at all; ^ begins and $ ends a word."""
    pairs, all_ = Counter(), Counter()
    for w in GENERAL:
        w = f"^{_plain(w)}$"
        pairs.update(zip(w, w[1:]))
        all_.update(w[:-1])
    return pairs, all_


def _plain(word: str) -> str:
    return "".join(c for c in unicodedata.normalize("NFKD", word.lower()) if c.isalpha())


def wordlike(part: str) -> bool:
    """Letters of one script in the case of a word, that follow each other as letters of words do; of other scripts than the Latin one, any letters."""
    if not part.isalpha() or not (part.islower() or part.isupper() or part[1:].islower() or not (part.lower() != part or part.upper() != part)):
        return False
    plain = _plain(part)
    if not plain.isascii():
        return not any("a" <= c <= "z" for c in plain)
    pairs, all_ = _letter_pairs()
    w = f"^{plain}$"
    return sum(math.log10((pairs[p] + 0.5) / (all_[p[0]] + 14)) for p in zip(w, w[1:])) / (len(w) - 1) >= WORDLIKE


def is_plain(value: str, before: str) -> bool:
    """Whether an unquoted value is no secret on the face of it: code that fetches one, or words as prose and forms have them.

    Behind "is" any words, joined by hyphens, slashes or apostrophes, are prose; behind a sign a name in code or one word, if it isn't longer than words are.
    """
    if before not in ("is", "sign"):
        return False
    if _CODE.match(value):
        return True
    words = [w for w in re.split(r"[-/'’_]" if before == "sign" else r"[-/'’]", value) if w]
    if before == "sign" and any(len(w) > LONGEST_WORD for w in words):
        return False
    return bool(words) and all(wordlike(w) for w in words)


def find(text: str, words: Words, threshold: float = THRESHOLD) -> list[tuple[int, int, str, float | None]]:
    """All spans (start, end, kind, log10 guesses) by start, then kind as listed; base spans have no cost."""
    base = base_spans(text)
    found = [(*s, None) for s in base]
    for a, b, before in _values(text):
        if is_plain(text[a:b].rstrip(".!?);"), before) or is_plain(text[a:b], before):
            continue
        while b > a and text[b - 1] in ".!?)":  # the end of a sentence is not part of the value
            b -= 1
        cost = guess_cost(text[a:b], words, blocks=True)
        if cost >= threshold:
            found.append((a, b, "guess", cost))
    return sorted(found, key=lambda s: (s[0], KINDS.index(s[2])))


def listed(found: list[tuple]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind, *_ in found)


_FOUND = T.StructType([
    T.StructField("n_assign", T.LongType()), T.StructField("n_access", T.LongType()), T.StructField("n_hex", T.LongType()),
    T.StructField("n_guess", T.LongType()), T.StructField("base_spans", T.StringType()), T.StructField("spans", T.StringType()),
    T.StructField("max_cost", T.DoubleType())])


def scan(docs: DataFrame, text: str = "text", words: tuple[str, ...] = WORDS, threshold: float = THRESHOLD) -> DataFrame:
    """Columns of ``docs`` with counts by kind, ``base_spans``, ``spans`` and ``max_cost``.

    ``words`` is the dictionary, most common first.

    Spans are ``kind:start:end`` in code points, the end exclusive, by start and
    joined by commas. ``max_cost`` is the highest guess cost reported, null if none.
    Null and empty texts have none; repeated rows each have their own; texts and values
    may be as long as a row may be (a block of 10,000 characters three times
    over takes a second); columns named like an output are replaced; an empty table gives no rows.
    """
    names = {f.name for f in _FOUND}
    others = [c for c in docs.columns if c.lower() not in names]
    source = docs.select(F.struct(*[F.col(f"`{c}`") for c in others], F.lit(0).alias("_")).alias("kept"), F.col(f"`{text}`").alias("text"))

    sent = docs.sparkSession.sparkContext.broadcast(tuple(words))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = dictionary(sent.value)
        for b in parts(batches):
            rows = []
            for t in utf8(b.column("text")):
                found = find(t.decode(), known, threshold)
                n = [sum(s[2] == k for s in found) for k in KINDS]
                rows.append((*n, listed([s for s in found if s[2] != "guess"]), listed(found), max((s[3] for s in found if s[3] is not None), default=None)))
            kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64()]
            yield pa.RecordBatch.from_arrays([b.column("kept"), *[pa.array(c, k) for c, k in zip(zip(*rows) if rows else [()] * 7, kinds)]], ["kept", *_FOUND.names])

    out = source.mapInArrow(run, T.StructType([source.schema["kept"], *_FOUND.fields]))
    return out.select(*[F.col(f"kept.`{c}`").alias(c) for c in others], *_FOUND.names)
