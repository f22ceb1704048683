"""Personal data with offset-preserving deobfuscation (operator 9).

Plain identifiers are found on the source text. Then transducers rewrite it one after the other: hidden
characters go first, so that they can't part what the others look for; then homoglyphs become the ASCII
characters they look like; then spelled digits become digits, disguised ``at`` and ``dot`` become ``@`` and ``.``. Each
keeps the offsets of what it rewrites, so an identifier found in the normalised text maps back through all of them to a
span of source characters. It is listed beside the plain ones, also where it contains or overlaps one, unless
it lies within one.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_right

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from streammetrics.llm.common import per_text, table

KINDS = ("email", "ip", "card", "phone")

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
_DIGIT = re.compile(r"[0-9]")
# starting only at the first digit of a run changes no match and keeps long runs linear
_IP = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_NOT_DIGIT = re.compile(r"[^0-9]")

Span = tuple[int, int, str]


def _emails(text: str):
    end = 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at) if start < at else None
        if m:
            end = m.end()
            yield start, end
        at = text.find("@", m.end() if m else at + 1)


def _small(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) <= 3 and int(part or 0) <= 255


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i % 2:
            d = 2 * d - 9 if d > 4 else 2 * d
        total += d
    return total % 10 == 0


def identifiers(text: str) -> list[Span]:
    """(start, end, kind) of plain identifiers, by start and then kind."""
    found = [(a, b, "email") for a, b in _emails(text)] if "@" in text else []
    if _DIGIT.search(text):
        found += [(m.start(), m.end(), "ip") for m in _IP.finditer(text) if all(map(_small, m.groups()))]
        for m in _CARD.finditer(text):
            if m.end() - m.start() >= 12:
                d = _NOT_DIGIT.sub("", m.group())
                if 12 <= len(d) <= 19 and luhn(d):
                    found.append((m.start(), m.end(), "card"))
        if "+" in text:
            for m in _PHONE.finditer(text):
                if 9 <= len(_NOT_DIGIT.sub("", m.group())) <= 15:
                    found.append((m.start(), m.end(), "phone"))
    return sorted(found, key=lambda s: (s[0], KINDS.index(s[2])))


def _homoglyphs() -> dict[int, str]:
    """Character → ASCII look-alike: full-width forms, digits of other scripts, Cyrillic and Greek letters."""
    out = {0xFF01 + i: chr(0x21 + i) for i in range(94)}
    for zero in (0x0660, 0x06F0, 0x0966, 0x1D7CE, 0x1D7D8, 0x1D7E2, 0x1D7EC, 0x1D7F6):
        out |= {zero + i: str(i) for i in range(10)}
    out |= dict(zip(map(ord, "асеорхуіјѕԁһкАВЕКМНОРСТХ"), "aceopxyijsdhkABEKMHOPCTX"))
    out |= dict(zip(map(ord, "αονρικΑΒΕΖΗΙΚΜΝΟΡΤΧ"), "aovpikABEZHIKMNOPTX"))
    out |= {0x2010: "-", 0x2011: "-", 0x2012: "-", 0x2013: "-", 0x2212: "-", 0x00A0: " ", 0x2024: ".", 0x3002: "."}
    return out


HOMOGLYPHS = _homoglyphs()
#: Characters that show nothing: zero-width, joiners, marks of direction, soft hyphen.
_HIDDEN = "\u200e\u200f\u2061\u2062\u2063\u2064\u200b\u200c\u200d\u2060\ufeff\u00ad"
_HIDDEN_RUN = re.compile(f"[{_HIDDEN}]+")
_ODD = re.compile("[" + "".join(map(chr, HOMOGLYPHS)).replace("-", "") + "]")
DIGIT_WORDS = {w: str(i % 10) for i, w in enumerate(
    ("zero", "one", "two", "three", "four", "five", "six", "seven", "eight", "nine"))}
_WORD = "(?:" + "|".join(DIGIT_WORDS) + ")"
_NUMBER = f"(?:{_WORD}|[0-9]+)"
# blanks are taken from the first of their run on, which keeps long runs linear
_OPEN, _CLOSE = r"(?:(?<!\s)\s+)?[\[({<]\s*", r"\s*[\])}>]\s*"
_DOT_RULE = (rf"{_OPEN}(?:dot|punkt|punto|point|\.){_CLOSE}|(?<=[a-z0-9])\s+(?:dot|\.)\s+(?=[a-z0-9])"
             r"|(?<=[a-z0-9])_dot_(?=[a-z0-9])")
_RULES = re.compile(
    rf"(?P<at>{_OPEN}(?:at|@|arroba){_CLOSE}|(?<!\s)\s+@\s+)"
    r"|(?P<spelled_at>(?<=\w)\s+at\s+(?=[a-z0-9-]+\s+dot\s)|(?<=[a-z0-9])_at_(?=[a-z0-9-]+_dot_))"
    rf"|(?P<dot>{_DOT_RULE})"
    rf"|(?P<plus>\bplus[\s-]+(?={_NUMBER}\b))"
    rf"|(?P<digits>\b{_NUMBER}(?:[\s-]+{_NUMBER})+\b)"
    rf"|(?P<digit>(?<![^\W0-9]){_WORD}(?![^\W0-9]))", re.IGNORECASE)  # only beside a dot, plus or digit, see _beside
_NEXT_DOT = re.compile(_DOT_RULE, re.IGNORECASE)
_ITEM = re.compile(r"[a-z]+|[0-9]+", re.IGNORECASE)
# A spelled "at" outside brackets is also an ordinary word: what follows must end like a domain, …
_DOMAIN_AFTER = re.compile(r"[a-z0-9-]+((?:(?:\s+dot\s+|_dot_|\.)[a-z0-9-]+)+)", re.IGNORECASE)
_LABEL = re.compile(r"(?:\s+dot\s+|_dot_|\.)([a-z0-9-]+)", re.IGNORECASE)
_LAST_WORD = re.compile(r"[a-z0-9._%+-]*\Z", re.IGNORECASE)
# Fixed values: … in one of the usual top-level domains (or two letters), and the word before it must not be one that
# ordinarily stands before "at".
TOP_LEVEL = frozenset("""com org net edu gov mil int info biz name pro mobi travel museum coop aero jobs app dev blog shop
    online site store tech cloud email xyz club live news example test invalid""".split())
BEFORE_AT = frozenset("""a aim aimed all always am an and are arrive arrived arrives be been being but call called came come
    day down even everyone find found glance good had happened has have he held her here him his home hosted i if in is
    it laugh laughed live lived lives located look looked looking looks me meet meeting meets met now off on only open
    or our out people point pointed see seen she sit sits smile smiled so stand stands stare stared start started starts stay
    stayed stays stop stopped that the their them then there these they this those time to today tonight up us use visit wait
    waited was we were when where which who work worked working works yell yelled you""".split())
# What every match of a rule contains, in lower case.
_BRACKETED = re.compile(r"[\[({<]\s*(?:at|dot|@|\.|arroba|punkt|punto|point)")
_SPELLED = re.compile(rf"{_WORD}[\s-]+{_NUMBER}|[0-9][\s-]+{_WORD}")
_SINGLE = re.compile(rf"[0-9.+]{_WORD}|{_WORD}[0-9.]")
_DOT, _AT = re.compile(r"\sdot\s|_dot_"), re.compile(r"\s@\s")
_SPACED_DOT = re.compile(r"[a-z0-9]\s+\.\s+[a-z0-9]")
_PLUS = re.compile(rf"plus[\s-]+{_NUMBER}")
_SIGNS, _AFTER = frozenset("0123456789.+"), frozenset("0123456789.")
_ODD_SET = frozenset(_HIDDEN) | frozenset(map(chr, HOMOGLYPHS))
_FOLDED = frozenset("\u0130\u0131\u017f\u212a")  # match i, s or k in the rules, but not all in lower case


def _odd(text: str) -> bool:
    """Whether the text has a homoglyph or hidden character."""
    if text.isascii():
        return False
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return not _ODD_SET.isdisjoint(text)
    return "\xa0" in text or "\xad" in text


def _may_hide(text: str) -> bool:
    """Whether a rule could match or the text is odd; true too often, but never false where one does."""
    if _odd(text) or not text.isascii() and not _FOLDED.isdisjoint(text):
        return True
    low = text.lower()
    if "dot" in low and _DOT.search(low) or "@" in low and _AT.search(low):
        return True
    if " ." in low and _SPACED_DOT.search(low) or "\n." in low and _SPACED_DOT.search(low):
        return True
    if any(c in low for c in "[({<") and _BRACKETED.search(low):
        return True
    if "plus" in low and _PLUS.search(low):
        return True
    return any(w in low for w in DIGIT_WORDS) and bool(_SPELLED.search(low) or _SINGLE.search(low))


def _beside(plain: str, start: int, end: int, sign: int) -> bool:
    """Whether a dot, plus or digit stands next to a word; ``sign`` is where the last rewritten dot or plus ended."""
    return (start == sign or plain[start - 1:start] in _SIGNS or plain[end:end + 1] in _AFTER
            or _NEXT_DOT.match(plain, end) is not None)


def _is_address(plain: str, start: int, end: int) -> bool:
    """Whether a spelled "at" stands between a name and a domain rather than in a sentence."""
    before = _LAST_WORD.search(plain, max(0, start - 64), start)
    if before is None or before.group().lower() in BEFORE_AT:
        return False
    after = _DOMAIN_AFTER.match(plain, end)
    labels = [m.group(1).lower() for m in _LABEL.finditer(after.group(1))] if after else []
    return any(label in TOP_LEVEL or len(label) == 2 and label.isalpha() for label in labels)


def without_hidden(text: str) -> tuple[str, list[int] | None]:
    """The text without hidden characters, and the source place of each character left (None: nothing went)."""
    if text.isascii() or not _HIDDEN_RUN.search(text):
        return text, None
    source: list[int] = []
    parts, at = [], 0
    for m in _HIDDEN_RUN.finditer(text):
        parts.append(text[at:m.start()])
        source.extend(range(at, m.start()))
        at = m.end()
    parts.append(text[at:])
    source.extend(range(at, len(text)))
    return "".join(parts), source


def normalise(text: str, lone: bool = True) -> tuple[str, list[tuple[int, int, int, bool]], bool]:
    """Normalised text, its stretches (normalised start, source start, source end, rewritten), and if a lone digit was.

    Without ``lone`` a spelled digit is rewritten beside other numbers only.
    """
    plain = text.translate(HOMOGLYPHS)  # one character for one
    out: list[str] = []
    stretches: list[tuple[int, int, int, bool]] = []
    size = 0

    def emit(piece: str, start: int, end: int, rewritten: bool) -> None:
        nonlocal size
        if piece:
            stretches.append((size, start, end, rewritten))
            out.append(piece)
            size += len(piece)

    odd = _odd(text)

    def copy(start: int, end: int) -> None:
        at = start
        for m in _ODD.finditer(text, start, end) if odd else ():
            emit(plain[at:m.start()], at, m.start(), False)
            emit(plain[m.start()], m.start(), m.end(), True)
            at = m.end()
        emit(plain[at:end], at, end, False)

    at, sign, alone = 0, -1, False
    for m in _RULES.finditer(plain):
        kind = m.lastgroup
        if kind == "digit":
            if not lone or not _beside(plain, m.start(), m.end(), sign):
                continue
            alone = True
        if kind == "digits" and not re.search("[a-z]", m.group(), re.IGNORECASE):
            continue
        if kind == "spelled_at" and not _is_address(plain, m.start(), m.end()):
            continue
        copy(at, m.start())
        at = m.end()
        sign = at if kind in ("dot", "plus") else -1
        if kind in ("digits", "digit"):
            for item in _ITEM.finditer(plain, m.start(), m.end()):
                emit(DIGIT_WORDS.get(item.group().lower(), item.group()), item.start(), item.end(), True)
        else:
            emit({"at": "@", "spelled_at": "@", "dot": ".", "plus": "+"}[kind], m.start(), m.end(), True)
    copy(at, len(text))
    return "".join(out), stretches, alone


def hidden_identifiers(text: str, base: list[Span]) -> list[Span]:
    """Spans of source characters whose normalised form holds an identifier that no base span contains.

    A lone digit may also belong to what stands before or after an identifier, so texts with one
    are read with and without it.
    """
    if not _may_hide(text):
        return []
    clean, source = without_hidden(text)
    normal, stretches, alone = normalise(clean)
    found = _mapped(text, base, normal, stretches, source)
    if alone:
        found += [s for s in _mapped(text, base, *normalise(clean, lone=False)[:2], source) if s not in found]
    return found


def _mapped(text: str, base: list[Span], normal: str, stretches: list[tuple[int, int, int, bool]],
            source: list[int] | None) -> list[Span]:
    if normal == text:
        return []
    begins = [s[0] for s in stretches]
    starts = [x for x, _, _ in base]
    reach: list[int] = []           # farthest end of the base spans up to each
    for _, y, _ in base:
        reach.append(max(y, reach[-1]) if reach else y)
    found = []
    for a, b, kind in identifiers(normal):
        first, last = bisect_right(begins, a) - 1, bisect_right(begins, b - 1) - 1
        n, s, _, rewritten = stretches[first]
        start = s if rewritten else s + a - n
        n, s, e, rewritten = stretches[last]
        end = e if rewritten else s + b - n
        if source is not None:
            start, end = source[start], source[end - 1] + 1
        if text[start:end] == normal[a:b]:
            continue  # nothing was rewritten here
        within = bisect_right(starts, start) - 1
        if within < 0 or reach[within] < end:
            found.append((start, end, kind))
    return found


def listed(spans: list[Span]) -> str:
    return ",".join(f"{kind}:{a}:{b}" for a, b, kind in spans)


def find(text: str) -> tuple[list[Span], list[Span]]:
    """(base spans, all spans), both by start and then kind."""
    base = identifiers(text)
    hidden = hidden_identifiers(text, base)
    return base, sorted(base + hidden, key=lambda s: (s[0], KINDS.index(s[2]), s[1])) if hidden else base


def redacted(text: str) -> str:
    """The text with every span, or union of overlapping spans, replaced by its kind in brackets."""
    spans = find(text)[1]
    if not spans:
        return text
    out, at = [], 0
    for a, b, kind in spans:
        if a >= at:
            out += [text[at:a], f"<{kind.upper()}>"]
        at = max(at, b)
    return "".join([*out, text[at:]])


def personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col``, base span counts by kind, base_sha256 and spans of every whole text.

    Spans are kind:start:end in code points, the end exclusive. Null counts as the empty text,
    which has no spans; repeated rows give the same row each; a text is read whole, in time linear in it; other
    columns are not read. Empty in, empty out.
    """
    def one(text: str):
        base, spans = find(text)
        kinds = [kind for _, _, kind in base]
        text_of_base = listed(base)
        return (*(kinds.count(k) for k in KINDS), hashlib.sha256(text_of_base.encode()).hexdigest(), listed(spans))

    return per_text(docs, one, "n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string",
                    id_col, text_col)


def redact(docs: DataFrame, text_col: str = "text", size_col: str = "n_chars") -> DataFrame:
    """``docs`` with its texts redacted and ``size_col``, where there is one, counted anew.

    Null texts stay null and rows without personal data stay as they are.
    """
    @F.pandas_udf("string")
    def clean(texts):
        return texts.map(lambda t: t if t is None else redacted(t))

    out = docs.withColumn(text_col, clean(text_col))
    if size_col in docs.columns:
        kind = docs.schema[size_col].dataType
        out = out.withColumn(size_col, F.coalesce(F.length(text_col).cast(kind), F.col(size_col)))
    return out.select(docs.columns)


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_data(table(spark, sf_dir, "documents"))


QUERIES = {"op9_pii": op9_pii}
