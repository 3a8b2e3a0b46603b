"""Credentials embedded in source code: find each literal value and replace it by a placeholder of equal length and alphabet.

A keyword automaton (Aho-Corasick) runs once over each text; only lines with a hit are looked at by the issuer-format and
context expressions. A match counts once its structure holds: token alphabets and lengths, JSON in a JWT's header, `user:word`
inside Basic logins, key material after a private key's opening line. Placeholders, references and plain words are refused.
"""

from __future__ import annotations

import base64
import binascii
import re
import zlib
from collections.abc import Iterator

import ahocorasick
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# fixed values: words near credentials (lower case); a line without any of them is never looked at
KEYWORDS = (
    "passw pwd passphrase pass pw secret token key auth bearer basic credential login connect dial conn open get sign_in signin client pool session "
    "private akia asia ghp_ gho_ ghu_ ghs_ ghr_ github_pat_ sk- sk_ rk_ hf_ xox glpat- eyj aiza npm_ pypi- sg. sig= signature= :// curl -u"
).split()

# fixed values: issuers' token formats
ISSUERS = (
    ("github", r"gh[pousr]_[A-Za-z0-9]{36,255}|github_pat_[A-Za-z0-9_]{50,255}"),
    ("gitlab", r"glpat-[A-Za-z0-9_\-]{20,}"),
    ("aws", r"(?:AKIA|ASIA)[A-Z2-7][A-Z0-9]{15}"),
    ("slack", r"xox[abprs]-\d{6,}-[A-Za-z0-9\-]{10,}"),
    ("model-api", r"sk-(?:[A-Za-z]+-)?[A-Za-z0-9_\-]{32,}"),
    ("payment", r"[sr]k_(?:live|test)_[A-Za-z0-9]{16,}"),
    ("hub", r"hf_[A-Za-z0-9]{30,}"),
    ("google", r"AIza[A-Za-z0-9_\-]{35}"),
    ("package", r"npm_[A-Za-z0-9]{36}|pypi-[A-Za-z0-9_\-]{50,}"),
    ("mail", r"SG\.[A-Za-z0-9_\-]{16,}\.[A-Za-z0-9_\-]{16,}"),
    ("jwt", r"eyJ[A-Za-z0-9_\-]{10,}\.eyJ[A-Za-z0-9_\-]{6,}\.[A-Za-z0-9_\-]{10,}"),
)
ISSUER = re.compile(r"(?<![A-Za-z0-9_\-])(?:" + "|".join(f"(?P<{k.replace('-', '_')}>{p})" for k, p in ISSUERS) + r")(?![A-Za-z0-9_])")
# the first of adjacent literals of one token
ISSUER_PART = re.compile(r"""(?<=["'`])(?:gh[pousr]_|glpat-|hf_|sk-|AKIA|xox[abprs]-|eyJ)[A-Za-z0-9_\-.]{6,}(?=["'`]\s*(?:$|[+,\\.]|["'`]))""")

_WORD = r"(?:pass(?:word|wd|phrase|code)?|pwd|pw|secret|token|(?:api|access|signing|secret|private|encryption|deploy|master|shared|auth|service|account|storage|license|admin|session)[_\-]?key|auth|credentials?|bearer|authorization|auth[_\-]?header)"
NAME = re.compile(
    rf"""(?ix){_WORD}\d{{0,3}}(?![A-Za-z0-9_\-])
    ["'`\]]*\s*
    (?::\s*(?:[&*]?\s*'?[A-Za-z_][\w<>'\[\].]*\s*)(?==[^=>])|\s+[a-z]\w*\s*(?==[^=>])|\[\]\s*(?==))?
    (?P<sep>:=|=>|=(?!=)|:(?!:))\s*
    (?:concat!\(|\(|\[|new\s+String\(|String::from\(|[bru]{{1,2}}(?=["']))?\s*
    (?P<q>["'`]{{3}}|["'`])?(?P<value>.*)"""
)
DEFINE = re.compile(rf"""(?i)#\s*define\s+\w*?{_WORD}\d{{0,3}}\s+\(?\s*"(?P<value>[^"\s]+)\"""")
# the next literal of a value that is broken into several
CONTINUED = re.compile(r"""["'`](?:\s*[+.\\]?\s*|,[ \t]*)["'`](?P<value>[A-Za-z0-9_\-+/=.]{4,})(?=["'`])(?!.\s*:)""")
URL_LOGIN = re.compile(r"[a-z][a-z0-9+.\-]*://[^\s/:@\"'`<>]*:(?P<value>[^\s/@\"'`]+)@[\w\[]", re.I)
URL_PARAM = re.compile(r"[?&](?:sig|signature|key|api_?key|token|access_?token|auth|secret|password|pwd)=(?P<value>[^&\s\"'`#<>)]+)", re.I)
HEADER = re.compile(r"(?<![\w])X-[\w\-]*(?:Key|Token|Secret|Auth|Password)[\w\-]*\s*[:=]\s*(?P<value>[^\s\"'`]+)", re.I)
SCHEME = re.compile(r"(?<![\w])(?:(?P<bearer>Bearer)|Basic)\s+(?P<value>[A-Za-z0-9_\-.~+/=]{8,})")
OPTION = re.compile(r"(?:--(?:password|passwd|pass|token|secret|api-key|auth-token)[ =]|\s-u\s+[\w.\-@]+:)[\"']?(?P<value>[^\s\"'`]+)", re.I)
REMARK = re.compile(r"\b(?:pass(?:word|wd|phrase)?|pwd|pw)\b\s*(?:is\b|was\b|[=:])?\s*[\"'`]?(?P<value>[^\s\"'`,;]+)", re.I)
DSN = re.compile(r"[;&\"'`]\s*(?:password|passwd|pwd|secret|accountkey|sharedaccesskey)=(?P<value>[^;&\s\"'`]+)", re.I)
CALL = re.compile(r"""\b[\w.:>\-]*?(?P<call>login|connect|dial|auth|sign_?in|open|get|conn|session|client|pool)\w*!?\(\s*(?P<first>[^()]*,\s*)?(?P<a>["'`])(?P<user>[\w.@\-]+)(?P=a)\s*,\s*(?P<b>["'`])(?P<value>[^"'`\s]+)(?P=b)\s*[,)]""", re.I)
KEY_BLOCK = re.compile(r"-----BEGIN (?:[A-Z0-9]+ )*PRIVATE KEY(?: BLOCK)?-----")
KEY_BODY = re.compile(r"(?:\\[nr]|[\s\"'`+,;\\]|//|#|\*)*(?:(?:Proc-Type|DEK-Info|Version|Comment)[^\n\\]*(?:\\n|\s)+)*(?P<body>[A-Za-z0-9+/]{16,})")
KEY_END = re.compile(r"-----END (?:[A-Z0-9]+ )*PRIVATE KEY(?: BLOCK)?-----")

PLACEHOLDER = re.compile(
    r"(?i)^(?:[x*.\-_#?0]+|<.*>?|\$.*|%.*%|\{\{.*|\{.*\}|.*\$\{.*|your[_\-].*|my[_\-](?:pass|secret|token|key).*|.*[_\-]here|replace.*|change[_\-]?(?:me|it|this).*|insert.*|todo.*|fixme.*|example.*|sample.*|dummy.*|fake.*|test|none|null|nil|undefined|true|false|redacted.*|masked.*|hidden|empty|default|placeholder.*|n/?a"
    r"|(?:env|vault|file|secret|ref|aws|arn|ssm|kms|op|keyring|process|os|config|settings|secrets)[:./].*|/.*|\.{1,2}/.*|https?://.*|@.*|!.*vault.*)$"
)
PLAIN = re.compile(r"^(?:[A-Za-z]?[a-z]+(?:[_\-./:][A-Za-z]?[a-z]+)*|[A-Z]+(?:[_\-./:][A-Z]+)*|[a-z]+(?:[A-Z][a-z]+)+|[a-z]+-\d{1,6}|[a-z]+_?\d{1,3}|[\d.,:\-+]+|[A-Za-z_]\w*\(.*)$")
PATH_LOGIN = re.compile(r"[\w.\-]:(?P<value>[^\s/\\@:]+)@[\w\[]")
# what every value has: a digit beside a letter or sign, or signs and letter cases mixed as no word or call has them
MIXED = re.compile(r"\d[A-Za-z#!*_@&^%$+/~\-]|[A-Za-z#!*@&^%$+/~\-]\d|[A-Za-z][#!*@&^%$~+][A-Za-z]|[a-z][A-Z]{2,}[a-z]|[A-Z]{2}[a-z]+[A-Z]|[A-Z0-9]{14,}|BEGIN")
UUID = re.compile(r"^[0-9a-fA-F]{8}(?:-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}$")
BARE = {"dotenv", "yaml", "shell", "markdown", "text"}


def strong(v: str, least: int = 8) -> bool:
    """A literal that could be a secret: no blanks, mixed characters, neither placeholder, reference, path nor plain words."""
    if len(v) < least or len(set(v)) < 5 or any(ch.isspace() for ch in v) or PLACEHOLDER.match(v) or PLAIN.match(v) or UUID.match(v):
        return False
    kinds = any(c.islower() for c in v) + any(c.isupper() for c in v) + any(c.isdigit() for c in v) + any(not c.isalnum() for c in v)
    return kinds >= 2 and any(c.isalpha() for c in v)


def is_basic(v: str) -> bool:
    """Base64 of `user:word` with a word that is no placeholder."""
    try:
        raw = base64.b64decode(v + "=" * (-len(v) % 4), validate=True).decode("utf-8")
    except (binascii.Error, ValueError):
        return False
    user, colon, word = raw.partition(":")
    return bool(colon and user and word) and raw.isprintable() and not PLACEHOLDER.match(word)


_BASE62 = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"


def has_checksum(token: str) -> bool:
    """Do the last six characters of a token with a prefix hold the CRC-32 of the rest in base 62, as some issuers publish it?"""
    body = token.rpartition("_")[2]
    n, digits = zlib.crc32(body[:-6].encode()), ""
    for _ in range(6):
        n, d = divmod(n, 62)
        digits = _BASE62[d] + digits
    return len(body) > 6 and digits == body[-6:]


def verified(kind: str, value: str) -> bool:
    """Does the value prove itself: a checksum, a readable JWT head, a readable login, key material? Others may be live all the same."""
    if kind in ("github", "package"):
        return not value.startswith(("github_pat_", "pypi-")) and has_checksum(value)
    return kind == "jwt" and is_jwt(value) or kind == "private-key" or kind == "login" and is_basic(value)


def is_jwt(v: str) -> bool:
    head = v.split(".", 1)[0]
    try:
        return b'"alg"' in base64.urlsafe_b64decode(head + "=" * (-len(head) % 4))
    except (binascii.Error, ValueError):
        return False


NEXT_LINE = re.compile(r"[=:]\s*(?:\(|concat!\(|\\|\[)?\s*\r?$", re.M)
_AUTOMATON = None


def _automaton() -> ahocorasick.Automaton:
    global _AUTOMATON
    if _AUTOMATON is None:
        a = ahocorasick.Automaton()
        for w in KEYWORDS:
            a.add_word(w, len(w))
        a.make_automaton()
        _AUTOMATON = a
    return _AUTOMATON


_FIRST_VALUE = re.compile(r"""\s*(?:concat!\(|\(|\[)?\s*(["'`])(?P<value>[^"'`\n]+)\1""")


def _line_spans(text: str, at: int, end: int, bare: bool) -> Iterator[tuple[int, int, str]]:
    """Spans (start, end, kind) of credential values that begin in text[at:end], one line."""
    line = text[at:end]
    for m in ISSUER.finditer(line):
        kind = m.lastgroup or ""
        body = m.group()
        if kind == "jwt" and not is_jwt(body) or len(set(body)) < 10:
            continue
        yield at + m.start(), at + m.end(), kind
    for m in ISSUER_PART.finditer(line):
        if len(set(m.group())) >= 8:
            yield at + m.start(), at + m.end(), "token"
            n = CONTINUED.match(text, at + m.end())
            while n:
                yield n.start("value"), n.end("value"), "continued"
                n = CONTINUED.match(text, n.end("value"))
    for m in SCHEME.finditer(line):
        v = m["value"]
        if m["bearer"] and len(v) >= 16 and strong(v) or not m["bearer"] and is_basic(v):
            yield at + m.start("value"), at + m.end("value"), "login"
    for rx, least in ((URL_LOGIN, 6), (URL_PARAM, 16), (HEADER, 16), (OPTION, 6), (DSN, 6)):
        for m in rx.finditer(line):
            if strong(m["value"], least):
                yield at + m.start("value"), at + m.end("value"), "login"
    for m in DEFINE.finditer(line):
        if strong(m["value"], 6) and not ISSUER.fullmatch(m["value"]) and not m["value"].startswith("-----") and "://" not in m["value"]:
            yield at + m.start("value"), at + m.end("value"), "password"
    for m in CALL.finditer(line):
        # calls of a general name also fetch settings: there a host before the user is asked for
        plain = m["call"].lower() in ("open", "get", "conn", "session", "client", "pool") and not m["first"]
        if strong(m["value"]) and not PLACEHOLDER.match(m["user"]) and not plain:
            yield at + m.start("value"), at + m.end("value"), "password"
    for m in REMARK.finditer(line):
        v = m["value"].rstrip(".)!?") if not strong(m["value"]) else m["value"]
        before = line[: m.start()]
        comment = any(x in before for x in ("#", "//", "/*", "--", "<!--", '"""')) or before.lstrip().startswith("*")
        if (bare or comment) and strong(v) and any(c.isdigit() for c in v):
            yield at + m.start("value"), at + m.start("value") + len(v), "password"
    pos = 0
    while m := NAME.search(line, pos):
        pos = m.end("sep")
        q, start = m["q"], at + m.start("value")
        rest = m["value"]
        if q:
            stop = rest.find(q[0])
            v = rest if stop < 0 else rest[:stop]
        elif not rest.strip() and not bare or rest.strip() in ("(", "concat!(", "\\"):
            # the literal stands on the next line
            if n := _FIRST_VALUE.match(text, end):
                if text.count("\n", end, n.start("value")) == 1 and strong(n["value"], 6) and not n["value"].startswith("-----"):
                    yield n.start("value"), n.end("value"), "password"
            continue
        elif bare or m["sep"] == "=" and any(x in line[: m.start()] for x in ("#", "//", "`")):
            v = re.split(r"[\s\"'`,;]", rest, maxsplit=1)[0]
        else:
            continue
        if v.startswith("-----"):
            continue
        scheme = re.match(r"(?:Bearer|Basic|Token)\s+", v)
        if scheme:
            continue  # settled above
        if strong(v, 6) and not v.startswith(("http://", "https://")) and "://" not in v:
            yield start, start + len(v), "password"


LONG, STEP = 20_000, 2_000


def _zone_spans(text: str, at: int, end: int, first: int, bare: bool) -> list[tuple[int, int, str]]:
    """As `_line_spans` for the values of one very long line that begin in the STEP characters from `first`: what stands around
    them is looked at too, and further on as long as a value reaches the window's end."""
    a, more = max(at, first - STEP), 3 * STEP
    while True:
        b = min(end, first + STEP + more)
        if first >= end or not MIXED.search(text, a, b) and not NEXT_LINE.search(text, a, b):
            return []
        got = [s for s in _line_spans(text, a, b, bare) if first <= s[0] < first + STEP or s[2] == "continued" and s[0] >= first]
        if b == end or all(s[1] < b for s in got):
            return got
        more *= 2


def find(text: str, language: str = "") -> list[tuple[int, int, str]]:
    """Spans (start, end, kind) of credential values in order, overlapping ones merged; kind `continued`: a further literal of the value before."""
    lower = text.lower()
    if len(lower) != len(text):  # a few letters change their length in lower case
        lower = "".join(c if len(c.lower()) > 1 else c.lower() for c in text)
    spans: list[tuple[int, int, str]] = []
    done = -1
    bare = language in BARE
    for stop, n in _automaton().iter(lower):
        if stop <= done:
            continue
        at, end = text.rfind("\n", 0, stop - n + 1) + 1, text.find("\n", stop)
        end = len(text) if end < 0 else end
        done = end
        if end - at > LONG:
            zones = {(x - k + 1 - at) // STEP for x, k in _automaton().iter(lower, at, end)}
            for z in sorted(zones | {z + 1 for z in zones}):
                spans += _zone_spans(text, at, end - (text[end - 1] == "\r"), at + z * STEP, bare)
            continue
        if not MIXED.search(text, at, end) and not NEXT_LINE.search(text, at, end):
            continue
        stop_at = end - (end > at and text[end - 1] == "\r")
        spans += _line_spans(text, at, stop_at, bare)
    if "PRIVATE KEY" in text:
        for m in KEY_BLOCK.finditer(text):
            body = KEY_BODY.match(text, m.end())
            if body:
                e = KEY_END.search(text, body.end())
                spans.append((m.start(), e.end() if e else body.end("body"), "private-key"))
    spans.sort()
    out: list[tuple[int, int, str]] = []
    for s in spans:
        if out and s[0] < out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], s[1]), out[-1][2])
        elif s[1] > s[0]:
            out.append(s)
    return out


def find_in_path(path: str) -> list[tuple[int, int, str]]:
    """As `find` for a path: `user:word@host` parts and issuers' tokens."""
    spans = [(m.start(), m.end(), m.lastgroup or "") for m in ISSUER.finditer(path)]
    taken = {x for a, b, _ in spans for x in (a, b)}
    spans += [(*m.span("value"), "login") for m in PATH_LOGIN.finditer(path) if not taken & set(m.span("value")) and strong(m["value"], 6)]
    return sorted(spans)


_HEX_DIGITS, _BASE32 = set("0123456789abcdefABCDEF"), set("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def _mask(piece: str) -> str:
    """As many characters of the same alphabet: hexadecimal stays hexadecimal, base 32 stays base 32, else letter cases and digits stay."""
    used = {c for c in piece if c.isalnum()}
    if used <= _HEX_DIGITS:
        digit, upper, lower = "0", "A", "a"
    elif used <= _BASE32 and len(piece) >= 16:
        digit, upper, lower = "2", "A", "a"
    else:
        digit, upper, lower = "0", "X", "x"
    return "".join(digit if c.isdigit() else upper if c.isupper() else lower if c.isalpha() else c for c in piece)


def _mask_key(piece: str) -> str:
    """Key material only: opening and closing line, escapes and quotes stay."""
    head, tail = re.match(r"-----BEGIN [A-Z0-9 ]+-----", piece), re.search(r"-----END [A-Z0-9 ]+-----$", piece)
    a, b = head.end() if head else 0, tail.start() if tail else len(piece)
    return piece[:a] + re.sub(r"\\[nrt]|[A-Za-z0-9]", lambda m: m.group() if len(m.group()) > 1 else _mask(m.group()), piece[a:b]) + piece[b:]


def redact(text: str, spans: list[tuple[int, int, str]]) -> str:
    """`text` with every span replaced by as many characters of the same kinds; all else is unchanged."""
    out, at = [], 0
    for a, b, kind in spans:
        out += [text[at:a], _mask_key(text[a:b]) if kind == "private-key" else _mask(text[a:b])]
        at = b
    return "".join([*out, text[at:]])


def find_credentials(df: DataFrame, text: str = "content", path: str = "file_path", language: str = "language", with_text: bool = True) -> DataFrame:
    """`df` with `cred_findings array<struct<line_no, kind, verified>>` (line 0: in the path; `verified`: by a checksum or by its structure) and, with `with_text`, `cred_text` and
    `cred_path`, the redacted forms. NULL text or path have no findings and stay NULL; empty text stays empty. Only the three
    named columns go through Python; a text is scanned whole. Each row is settled alone, so nothing is shuffled.
    """

    def run(parts: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for texts, paths, langs in parts:
            rows = []
            for t, p, g in zip(texts, paths, langs):
                found, new_t, new_p = [], t, p
                if p:
                    s = find_in_path(p)
                    found += [{"line_no": 0, "kind": k, "verified": verified(k, p[a:b])} for a, b, k in s[:1]]
                    new_p = redact(p, s) if s else p
                if t:
                    s = find(t, (g or "").strip().lower())
                    seen = set()
                    for a, b, k in s:
                        if k == "continued":
                            continue
                        n = t.count("\n", 0, a) + 1
                        if n not in seen:
                            seen.add(n)
                            found.append({"line_no": n, "kind": k, "verified": verified(k, t[a:b])})
                    new_t = redact(t, s) if s else t
                rows.append((found, new_t, new_p) if with_text else (found,))
            yield pd.DataFrame(rows, columns=["f", "t", "p"] if with_text else ["f"])

    kind = "f array<struct<line_no int, kind string, verified boolean>>" + (", t string, p string" if with_text else "")
    out = df.withColumn("_cred", F.pandas_udf(run, kind).asNondeterministic()(F.col(text), F.col(path), F.col(language)))
    cols = {"cred_findings": F.col("_cred.f")} | ({"cred_text": F.col("_cred.t"), "cred_path": F.col("_cred.p")} if with_text else {})
    return out.withColumns(cols).drop("_cred")
