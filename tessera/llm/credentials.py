"""Credentials written into texts: found, validated and masked.

A keyword automaton runs once over each lower-cased text; only windows of lines around its hits are looked at
further. There the formats of issuers, URLs with a password, authorization headers, private-key blocks and
assignments to secret-like names are matched, each match is checked for structure (placeholders, references,
checksums, ids and prose are no credentials), and what is left is replaced by a filler of the same length and
alphabet, so quotes, escapes, line ends and key armour stay in place.

Issuer tokens that carry a checksum (GitHub, npm: CRC32 in base 62) or a decodable structure (JWT header) are
``issuer_token`` where it holds; where it does not, as in tokens of older formats, the body has to look random and the
kind is ``issuer_token_unverified``. A private key needs a base64 body and ends with its END line or its last body line.
Values of the shape of digests and ids (40, 64, 96 or 128 hexadecimal digits, UUIDs) are judged by their name and
line: keys and secrets take them, bare "token" and "password" names only with a qualifier such as access or client.

Defined results: null and empty texts have no credentials and stay as they are; repeated rows of a key count once and
rows of one key with differing texts each give their rows, null keys included; a line with several credentials is
reported once; a null ``start_line`` gives a null line number.
"""

from __future__ import annotations

import base64
import binascii
import json
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Words whose presence makes a line worth a look.
KEYWORDS = (
    "passw", "passphrase", "pwd", "secret", "token", "apikey", "api_key", "api-key", "access_key", "accesskey", "access-key", "_pass", "-pass", "curl",
    "signing_key", "signingkey", "signing-key", "private key", "private_key", "privatekey", "auth", "bearer ", "basic ", "credential", "login(", "akia", "asia",
    "ghp_", "gho_", "ghs_", "ghu_", "ghr_", "glpat-", "xoxb-", "xoxp-", "xoxa-", "xoxs-", "_live_", "_test_", "aiza", "eyj", "sk-", "://",
    "pypi-", "sg.", "npm_", "hf_", "gocspx-", "dop_v1_", "shpat_", "whsec_",
)

# Public token formats.
_ISSUER = re.compile(
    r"(?<![A-Za-z0-9_])(?:(?:AKIA|ASIA)[A-Z2-7]{16}|gh[pousr]_[A-Za-z0-9]{36}|github_pat_[A-Za-z0-9]{22}_[A-Za-z0-9]{59}|npm_[A-Za-z0-9]{36}|glpat-[A-Za-z0-9_-]{20}|xox[abeprs]-[0-9A-Za-z-]{16,}"
    r"|[a-z]{2,6}_(?:live|test)_[A-Za-z0-9]{20,}|whsec_[A-Za-z0-9+/=]{24,}|sk-[A-Za-z0-9_-]{24,}|AIza[0-9A-Za-z_-]{35}|GOCSPX-[A-Za-z0-9_-]{28}|hf_[A-Za-z0-9]{34}|dop_v1_[0-9a-f]{64}|shpat_[0-9a-f]{32}"
    r"|pypi-[A-Za-z0-9_-]{50,}|SG\.[A-Za-z0-9_-]{22}\.[A-Za-z0-9_-]{43}|eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{16,})(?![A-Za-z0-9_])"
)
_WEBHOOK = re.compile(r"https://(?:hooks\.slack\.com/services/(T[A-Z0-9]{6,}/B[A-Z0-9]{6,}/[A-Za-z0-9]{20,})|(?:canary\.|ptb\.)?discord(?:app)?\.com/api/webhooks/(\d{15,}/[A-Za-z0-9_-]{50,}))")
_BASE62 = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
_URL = re.compile(r"\b[a-z][a-z0-9+.-]{1,20}://([^\s/:@'\"`<>]*):([^\s/@'\"`<>]+)@[A-Za-z0-9_.-]", re.I)
_HEADER = re.compile(r"\b(?:Bearer|Basic|Token)\s+([A-Za-z0-9._~+/=-]{8,})", re.I)
_ARMOUR = re.compile(r"-----BEGIN (?:[A-Z0-9]+ )*PRIVATE KEY(?: BLOCK)?-----")
_ARMOUR_END = re.compile(r"-----END (?:[A-Z0-9]+ )*PRIVATE KEY(?: BLOCK)?-----")
#: What may stand between the lines of a key: line ends, escaped ones, quotes and joins, indentation and comment marks.
_KEY_GAP = re.compile(r"(?:\\+[nr]|[ \t\r\n\"'`,#*>|;()]|\\(?=\r?\n)|\+(?=[ \t]*(?:[\"'`\\]|\r?\n))|//(?=[ \t]))*")
_KEY_FIELD = re.compile(r"[A-Za-z-]{4,20}: [^\r\n\\]*")
_KEY_LINE = re.compile(r"=?[A-Za-z0-9+/]+={0,2}")
_NAME = r"[A-Za-z_$][\w.$-]*"
_LITERAL = r"[rbuf]{0,2}(?:\"(?:[^\"\\\n]|\\.)*\"|'(?:[^'\\\n]|\\.)*'|`[^`\n]*`)"
#: name = "literal", with an optional type, joined parts, and list or table marks around.
_QUOTED = re.compile(rf"(?<![\w$])[\"'`]?(--?)?({_NAME})[\"'`]?(?:\s*:\s*[\w.\[\]<>|]+)?\s*(?::=|=>|[=:,|])\s*\(?\s*({_LITERAL}(?:\s*(?:\+|\\)?\s*{_LITERAL})*)")
#: name = value without quotes, to the end of the line.
_BARE = re.compile(rf"(?<![\w$])(--?)?({_NAME})\s*(?::=|[=:])\s*([^\s\"'`#;,(){{}}\[\]<>][^\s\"'`;,(){{}}\[\]<>]*)(?=[\"'\s;,)\]]|$)")
#: name: >- and the value on the next line, or name: and a value on its own on the next line.
_BELOW = re.compile(rf"(?<![\w$])[\"'`]?({_NAME})[\"'`]?\s*[:=]\s*(?:[>|][+-]?|\\|\()?[ \t]*\r?\n(?:[ \t]*```\w*\r?\n)?[ \t]*(?:[\"'`])?([^\s\"'`]+)(?:[\"'`])?[ \t]*\)?(?=\r?\n|$)")
#: - name: SECRET_NAME and value: x on the next line.
_PAIR = re.compile(rf"\bname[\"']?\s*:\s*[\"']?({_NAME})[\"']?\s*,?[ \t]*\r?\n?[ \t]*[\"']?value[\"']?\s*:\s*[\"']?([^\s\"',}}]+)", re.I)
#: Use `x` as secret_name.
_PROSE = re.compile(rf"`([^`\s]{{8,}})`\s+(?:as|for|is)\s+(?:the\s+)?`?({_NAME})")
_LOGIN = re.compile(r"\b(?:login|authenticate|signin|sign_in|set_password|basic_auth)\(\s*(?:[\"'][^\"'\n]*[\"']\s*,\s*)([\"'])([^\"'\n]+)\1", re.I)
_USERPASS = re.compile(r"(?<![\w-])(?:-u|--user|--proxy-user)[ =]+[\"']?[^\s:\"'$]+:([^\s\"'`]+)")
#: A line that goes on with the string join of the line above.
_CONTINUED = re.compile(r"[ \t]*(?:\+[ \t]*)?[rbuf]{0,2}[\"'`][^\n]*[\"'`][ \t]*(?:\+|\\)?[ \t;,)]*\r?(?:\n|\Z)")
_PART = re.compile(r"([\"'`])((?:(?!\1)[^\\\n]|\\.)*)\1")

_SPLIT = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|\d+")
_LAST = frozenset(("password", "passwd", "pwd", "passphrase", "passcode", "secret", "token", "apikey", "credential", "credentials", "pw"))
# Words that make a name speak about a credential without holding one.
_ABOUT = frozenset(
    ("env", "ref", "file", "field", "label", "ttl", "limit", "url", "uri", "id", "ids", "name", "type", "count", "path", "header", "hash", "length", "len", "expiry", "expires", "policy", "prompt", "hint", "placeholder", "checksum", "digest", "fingerprint", "version", "min", "max", "size", "timeout", "regex", "pattern", "error", "public", "num", "budget", "estimate")
)
_LAST_TWO = frozenset(("api", "access", "secret", "signing", "private", "auth", "encryption", "account", "master", "shared", "session", "deploy"))
_PLACEHOLDER = re.compile(
    r"^(?:x+|X+|\*+|\.+|-+|0+|[xX0\W_]+)$|^<.*>$|^\[.*\]$|\$\{|\{\{|\$\(|^\$|^%|^\{|^@|\.\.\.|your[_-]|replace|change[_-]?me|dummy|example|placeholder|not[_-]?set|todo|fixme|redacted|sample[_-]|insert[_-]|^(?:none|null|nil|true|false|undefined|test|secret|password|token|empty|unset|default)$",
    re.I,
)
_DIGEST = re.compile(r"sha\d+[:-].*", re.I | re.S)
#: The shapes of object ids, digests and request ids; a key or secret may have them too.
_IDS = re.compile(r"[0-9a-f]{40}|[0-9a-f]{64}|[0-9a-f]{96}|[0-9a-f]{128}|[0-9a-f]{8}-(?:[0-9a-f]{4}-){3}[0-9a-f]{12}", re.I)
_KEYLIKE = frozenset(("key", "apikey", "secret", "credential", "credentials"))
# Words that make a token or password that of a service or account.
_QUALIFIERS = frozenset(
    "api access auth authentication bearer refresh client secret signing session deploy service account admin root db database smtp bot personal private user github gitlab slack npm vault jwt oauth csrf webhook".split()
)
# What a line says of an id or digest.
_ID_TALK = re.compile(r"\b(?:commits?|revision|checksum|digest|sha-?\d*|md5|etag|hash|trace|correlation|request[_ -]?id|uuid of|fingerprint)\b", re.I)
_WORDS = re.compile(r"^[A-Za-z]+(?:[_-][A-Za-z]+)*$")
# Words of messages and labels, which a passphrase would not hold.
_PROSE_WORDS = frozenset(
    "a an and are as at be by can cannot enter expired failed field for forgot from has have if in incorrect invalid is it key keys missing must my new no not of on or our password passwords please required reset secret set should that the this to token tokens use user valid was when with wrong you your".split()
)
_PASSWORD = re.compile(r"(?:password|passwd|pwd|pass|passphrase|passcode|pw)\d*$", re.I)
_B64 = re.compile(r"^[A-Za-z0-9+/]{8,}={0,2}$")


@lru_cache(maxsize=1)
def _automaton() -> ahocorasick.Automaton:
    a = ahocorasick.Automaton()
    for w in KEYWORDS:
        a.add_word(w, len(w))
    a.make_automaton()
    return a


def secret_name(name: str) -> bool:
    """Whether a variable or field of this name holds a credential."""
    words = [w.lower() for w in _SPLIT.findall(name)]
    while words and words[-1].isdigit():
        words.pop()
    if not words:
        return False
    if words[-1] in _LAST or len(words) > 1 and (words[-1] == "key" and words[-2] in _LAST_TWO or words[-1] == "pass"):
        return True
    if _ABOUT.intersection(words):
        return False
    return any(w in _LAST and w != "pw" or w == "key" and i and words[i - 1] in _LAST_TWO for i, w in enumerate(words))


def _decoded(value: str) -> str | None:
    if not _B64.match(value) or len(value) % 4:
        return None
    try:
        out = base64.b64decode(value, validate=True).decode("ascii")
    except (binascii.Error, UnicodeDecodeError):
        return None
    return out if out.isprintable() else None


def _random(body: str) -> bool:
    """Whether characters look drawn at random: many different ones, no long runs, no counting up."""
    if len(set(body)) < min(8, max(4, len(body) // 3)):
        return False
    steps = [ord(b) - ord(a) for a, b in zip(body, body[1:])]
    return sum(x in (0, 1, -1) for x in steps) <= len(steps) // 3


def _checksum_holds(token: str) -> bool:
    """GitHub and npm tokens end with the CRC32 of their body in base 62."""
    body, tail = token.split("_", 1)[1][:-6], token[-6:]
    n, out = zlib.crc32(body.encode()), ""
    while n:
        n, r = divmod(n, 62)
        out = _BASE62[r] + out
    return out.rjust(6, "0") == tail


def _header_decodes(token: str) -> bool:
    """A web token begins with a JSON object that names its algorithm."""
    head = token.split(".", 1)[0]
    try:
        got = json.loads(base64.urlsafe_b64decode(head + "=" * (-len(head) % 4)))
    except (ValueError, binascii.Error):
        return False
    return isinstance(got, dict) and "alg" in got


def issuer_kind(token: str) -> str | None:
    """``issuer_token``, ``issuer_token_unverified`` or, for placeholders and examples, None."""
    if _PLACEHOLDER.search(token) or "EXAMPLE" in token:
        return None
    if token.startswith(("ghp_", "gho_", "ghu_", "ghs_", "ghr_", "npm_")):
        sure = _checksum_holds(token)
    elif token.startswith("eyJ"):
        sure = _header_decodes(token)
    else:
        return "issuer_token" if _random(re.split(r"_(?:live|test|v1)_|[_-]|(?<=AKIA)|(?<=ASIA)|(?<=AIza)|(?<=SG)\.", token, maxsplit=1)[-1]) else None
    if sure:
        return "issuer_token"
    return "issuer_token_unverified" if all(_random(p) for p in re.split(r"[._]", token)[0 if token[0] == "e" else 1 :] if len(p) >= 8) else None


def _id_like(value: str, name: str, line: str) -> bool:
    """Whether a value is rather a digest or an id than a credential, by its shape, name and line."""
    if _DIGEST.fullmatch(value):
        return True
    if not _IDS.fullmatch(value):
        return False
    words = [w.lower() for w in _SPLIT.findall(name)]
    while words and words[-1].isdigit():
        words.pop()
    if _ID_TALK.search(line.replace(value, "")):
        return True
    return not words or words[-1] not in _KEYLIKE and not _QUALIFIERS.intersection(words)


def _passphrase(value: str) -> bool:
    """Several words that read like no message: blanks or dashes between them, no words of prose, no placeholder."""
    words = re.split(r"[\s_-]+", value.strip())
    if _PROSE_WORDS.intersection(w.lower().strip(".,!?:") for w in words):
        return False
    mixed = any(c.isdigit() for c in value) and any(c.isupper() for c in value) and any(c.islower() for c in value)
    return (mixed and len(words) <= 6) or len(words) >= (4 if any(c.isspace() for c in value) else 3) and all(w.isalpha() and len(w) >= 2 for w in words)


def _odd_case(part: str) -> bool:
    """A run of letters whose capitals no word has: inside it, or at its end."""
    return len(part) >= 4 and not (part.islower() or part.isupper() or part.istitle()) and not re.fullmatch(r"[A-Z]?[a-z]+(?:[A-Z][a-z]+)+", part)


def plausible(value: str, *, bare: bool = False, name: str = "", line: str = "") -> bool:
    """Whether a literal given to a secret-like name is a usable credential.

    ``bare``: it stands without quotes; ``name`` and ``line``: what it is given to, and its line.
    """
    word = bool(_PASSWORD.search(name))
    if len(value) < 6 or _PLACEHOLDER.search(value) or _id_like(value, name, line):
        return False
    if any(c.isspace() for c in value):
        return word and not bare and "\n" not in value and _passphrase(value)
    if value.isdigit():
        return word and not bare and len(set(value)) > 1
    if "://" in value or value.startswith(("./", "~")):
        return False
    digit, upper, lower = any(c.isdigit() for c in value), any(c.isupper() for c in value), any(c.islower() for c in value)
    if value.startswith("/") and not (len(value) >= 32 and digit and upper and lower):
        return False
    inner = _decoded(value)
    if inner is not None and (_PLACEHOLDER.search(inner) or _id_like(inner, "", "")):
        return False
    if word and value.count("-") >= 2 and _WORDS.match(value) and _passphrase(value):
        return True
    if not digit and not (upper and lower):
        return False
    if bare and not digit and _WORDS.match(value) and not any(map(_odd_case, re.split(r"[_-]", value))):
        return False
    if bare and re.match(r"^[A-Za-z_]\w*(?:\.\w+)+$", value) and not _ISSUER.fullmatch(value):
        return False
    if not digit and re.fullmatch(r"[A-Za-z]+", value) and len(value) < 16 or re.fullmatch(r"[a-z]+(?:[A-Z][a-z]+)+\d{0,1}|(?:[A-Z][a-z]+){2,}", value):
        return False
    return True


def private_key_end(text: str, at: int) -> int | None:
    """End of the private key whose BEGIN line ends at ``at``; None where no key follows.

    Header fields may come before the body. Without an END line right after it, the body goes on while its lines are
    as long as the first, and a last shorter one counts if it is padded.
    """
    pos = _KEY_GAP.match(text, at).end()
    while (m := _KEY_FIELD.match(text, pos)) is not None:
        pos = _KEY_GAP.match(text, m.end()).end()
    ends: list[tuple[int, int]] = []
    while (m := _KEY_LINE.match(text, pos)) is not None:
        ends.append((m.end(), m.end() - m.start()))
        nxt = _KEY_GAP.match(text, m.end()).end()
        if nxt == m.end():
            break
        pos = nxt
    end = _ARMOUR_END.match(text, pos)
    if end and ends:
        body = text[at:pos]
        drawn = any(c.isdigit() for c in body) and any(c.isupper() for c in body) and any(c.islower() for c in body)
        # a short body (test keys) must not be words with blanks between them
        if sum(n for _, n in ends) >= 32 and max(n for _, n in ends) >= 16 or drawn and sum(n for _, n in ends) >= 12 and not re.search(r"[\w+/] +[\w+/]", body):
            return end.end()
    if not ends or ends[0][1] < 40:
        return None
    width, last, k = ends[0][1], ends[0][0], 1
    while k < len(ends) and ends[k][1] == width:
        last, k = ends[k][0], k + 1
    if k < len(ends) and ends[k][1] < width and text[ends[k][0] - 1] == "=":
        last = ends[k][0]
    return last


def _windows(text: str) -> list[tuple[int, int]]:
    """Line ranges (with two more lines below each hit) that hold a keyword, merged."""
    lower = text.lower()
    if len(lower) != len(text):
        lower = "".join(c.lower() if len(c.lower()) == 1 else c for c in text)
    out: list[list[int]] = []
    for end, _ in _automaton().iter(lower):
        if out and end < out[-1][2]:
            continue
        a = text.rfind("\n", 0, end) + 1
        z = text.find("\n", end)
        z = len(text) if z < 0 else z
        stop = z
        for _ in range(2):
            nxt = text.find("\n", stop + 1)
            stop = len(text) if nxt < 0 else nxt
        if not out or stop > out[-1][1]:  # else the window before has gone on to here already
            while stop < len(text) and _CONTINUED.match(text, stop + 1):
                nxt = text.find("\n", stop + 1)
                stop = len(text) if nxt < 0 else nxt
        if out and a <= out[-1][1]:
            out[-1][1:] = [max(stop, out[-1][1]), z]
        else:
            out.append([a, stop, z])
    return [(a, b) for a, b, _ in out]


def _line(text: str, at: int) -> str:
    z = text.find("\n", at)
    return text[text.rfind("\n", 0, at) + 1 : len(text) if z < 0 else z]


def find_credentials(text: str | None) -> list[tuple[int, int, str]]:
    """``(start, end, kind)`` of each credential, in order and without overlaps."""
    if not text:
        return []
    spans: list[tuple[int, int, str]] = []
    for a, z in _windows(text):
        w = text[a:z]
        for m in _ARMOUR.finditer(w):
            e = private_key_end(text, a + m.end())
            if e is not None:
                spans.append((a + m.start(), e, "private_key"))
        for m in _ISSUER.finditer(w):
            kind = issuer_kind(m.group())
            if kind:
                spans.append((a + m.start(), a + m.end(), kind))
        for m in _WEBHOOK.finditer(w):
            i = 1 if m.group(1) else 2
            if _random(m.group(i).rsplit("/", 1)[1]):
                spans.append((a + m.start(i), a + m.end(i), "webhook"))
        for m in _URL.finditer(w):
            if not _PLACEHOLDER.search(m.group(2)) and "{" not in m.group(2) and "$" not in m.group(2):
                spans.append((a + m.start(2), a + m.end(2), "url_password"))
        for m in _HEADER.finditer(w):
            v = m.group(1)
            inner = _decoded(v)
            if m.group()[:5].lower() == "basic":
                good = inner is not None and ":" in inner and not _PLACEHOLDER.search(inner.split(":", 1)[1])
            else:
                good = plausible(v, bare=True, name="bearer_token", line=_line(w, m.start())) and any(c.isdigit() for c in v)
            if good:
                spans.append((a + m.start(1), a + m.end(1), "header"))
        for m in _QUOTED.finditer(w):
            if secret_name(m.group(2)):
                parts = list(_PART.finditer(m.group(3)))
                value = "".join(p.group(2) for p in parts)
                if parts and plausible(value, name=m.group(2), line=_line(w, m.start(3))):
                    base = a + m.start(3)
                    spans.append((base + parts[0].start(2), base + parts[-1].end(2), "assignment"))
        for m in _BARE.finditer(w):
            if secret_name(m.group(2)) and plausible(m.group(3), bare=True, name=m.group(2), line=_line(w, m.start(3))):
                spans.append((a + m.start(3), a + m.end(3), "assignment"))
        for m in _BELOW.finditer(w):
            if secret_name(m.group(1)) and plausible(m.group(2), bare=True, name=m.group(1), line=_line(w, m.start(2))):
                spans.append((a + m.start(2), a + m.end(2), "assignment"))
        for m in _PAIR.finditer(w):
            if secret_name(m.group(1)) and plausible(m.group(2), bare=True, name=m.group(1), line=_line(w, m.start(2))):
                spans.append((a + m.start(2), a + m.end(2), "assignment"))
        for m in _PROSE.finditer(w):
            if secret_name(m.group(2)) and plausible(m.group(1), name=m.group(2), line=_line(w, m.start())):
                spans.append((a + m.start(1), a + m.end(1), "prose"))
        for m in _USERPASS.finditer(w):
            if len(m.group(1)) >= 6 and not _PLACEHOLDER.search(m.group(1)) and "$" not in m.group(1):
                spans.append((a + m.start(1), a + m.end(1), "login"))
        for m in _LOGIN.finditer(w):
            if plausible(m.group(2), name="password"):
                spans.append((a + m.start(2), a + m.end(2), "login"))
    spans.sort(key=lambda s: (s[0], -s[1]))
    out: list[tuple[int, int, str]] = []
    for s in spans:
        if out and s[0] < out[-1][1]:
            if s[1] > out[-1][1]:
                out[-1] = (out[-1][0], s[1], out[-1][2])
        else:
            out.append(s)
    return out


_FILL = str.maketrans({**{chr(c): "0" for c in range(48, 58)}, **{chr(c): "X" for c in range(65, 91)}, **{chr(c): "x" for c in range(97, 123)}})
_KEEP = re.compile(r"(\\u[0-9a-fA-F]{4}|\\U[0-9a-fA-F]{8}|\\x[0-9a-fA-F]{2}|\\N\{[^}]*\}|%[0-9A-Fa-f]{2}|\\.|-----(?:BEGIN|END) [A-Z0-9 ]+-----|[\"'`]\s*(?:\+|\\)?\s*[rbuf]{0,2}[\"'`])", re.S)


def mask(text: str | None, spans: list[tuple[int, int, str]] | None = None) -> str | None:
    """``text`` with each credential replaced by a filler of the same length and alphabet.

    Digits become 0 and letters x or X; quotes, joins, escapes, line ends and key armour stay.
    """
    if not text:
        return text
    out, at = [], 0
    for s, e, _ in find_credentials(text) if spans is None else spans:
        out.append(text[at:s])
        out += [p if i % 2 else p.translate(_FILL) for i, p in enumerate(_KEEP.split(text[s:e]))]
        at = e
    out.append(text[at:])
    return "".join(out)


def credential_lines(df: DataFrame, key: str = "chunk_id", text: str = "text", start_line: str = "start_line") -> DataFrame:
    """``(key, line_no, kinds)`` for each line in which a credential begins."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for k, first, t in zip(pdf["key"], pdf["start_line"], pdf["text"]):
                found = find_credentials(t)
                if not found:
                    continue
                ends = np.fromiter((m.start() for m in re.finditer("\n", t)), dtype=np.int64)
                at: dict[int, set[str]] = {}
                for s, _, kind in found:
                    at.setdefault(int(np.searchsorted(ends, s)), set()).add(kind)
                rows += [(k, None if pd.isna(first) else int(first) + n, ",".join(sorted(kinds))) for n, kinds in at.items()]
            out = pd.DataFrame(rows, columns=["key", "line_no", "kinds"])
            out["line_no"] = out["line_no"].astype("Int32")
            yield out

    src = df.select(df[key].alias("key"), df[start_line].cast("int").alias("start_line"), df[text].alias("text")).filter(F.length("text") > 0)
    schema = T.StructType([T.StructField("key", src.schema["key"].dataType), T.StructField("line_no", T.IntegerType()), T.StructField("kinds", T.StringType())])
    return src.mapInPandas(run, schema).distinct().withColumnRenamed("key", key)


def redact(df: DataFrame, key: str = "chunk_id", text: str = "text") -> DataFrame:
    """``(key, n_credentials, text)`` with masked texts, one row a key and text."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            found = [find_credentials(t) for t in pdf["text"]]
            yield pd.DataFrame({"key": pdf["key"], "n_credentials": [len(f) for f in found], "text": [mask(t, f) for t, f in zip(pdf["text"], found)]}).astype({"n_credentials": "int32"})

    src = df.select(df[key].alias("key"), df[text].alias("text"))
    src = src.withColumns({"h": F.xxhash64("text"), "n": F.length("text")}).dropDuplicates(["key", "h", "n"]).select("key", "text")
    schema = T.StructType([T.StructField("key", src.schema["key"].dataType), T.StructField("n_credentials", T.IntegerType()), T.StructField("text", T.StringType())])
    return src.mapInPandas(run, schema).withColumnRenamed("key", key)
