"""Secret scan: fixed patterns, and an assignment-aware lexer.

The patterns find literal shapes (``assign``, ``access``, ``hex``). The lexer
reads source and configuration syntax as name-literal pairs: ``name = "x"``,
``name: 'x'``, ``"name": "x"``, ``name := x``, ``name => "x"``, ``NAME=x``, with a
type after the name (``name: str = "x"``, ``var name string = "x"``) and with a
key in brackets (``a["name"] = "x"``, ``a[:name] = "x"``), ``#define NAME "x"``,
``a, name = "u", "x"``, ``<name>x</name>``, ``<add key="name" value="x"/>`` and
``name=x`` inside a string (connection strings). A value may be a string in
three quotes, in parentheses over several lines, on the line after the operator,
or a YAML block (``name: |``); an operator may stand on the line after its name.
It propagates constants (a name stands for the literals last assigned to it, also
inside ``a + "x"`` and ``${a}``), and scores the literals that reach a target
by the words of the target's name. A literal that reaches a sensitive name is a
span of kind ``pair``, at the place where the literal stands. A literal with
blanks counts where it is a private key, a scheme and a token (``Bearer x``), one
token folded over lines, or a passphrase (see :func:`spaced_secret`).

One pass over whole texts, no shuffle. Work is linear in a text's length: each
operator is lexed once, and values of names are shared nodes, not copies.

Cases: null is an empty text and has no span; every row is scanned for itself,
so repeated rows repeat their result and a null id stays null; a name assigned
again takes its new value (the last one before a use counts); a span inside
another one is not told; an empty table
gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

KINDS = ("assign", "access", "hex", "pair")
_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                     re.IGNORECASE | re.ASCII)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{32,}")


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the fixed patterns, in order of kind."""
    out = [(*m.span(), "assign") for m in _ASSIGN.finditer(text) if len(m[2]) >= 8]
    if "AKIA" in text:
        out += [(*m.span(), "access") for m in _ACCESS.finditer(text) if m.end() - m.start() >= 16]
    return out + [(*m.span(), "hex") for m in _HEX.finditer(text)]


# --- names ------------------------------------------------------------------

#: Words of a target name and what they add to its score; at SENSITIVE a
#: literal that reaches it counts as a secret.
NAME_SCORES = {
    "password": 3, "passwd": 3, "passphrase": 3, "passcode": 3, "pwd": 3, "secret": 3, "credential": 3,
    "credentials": 3, "token": 3, "apikey": 3, "privatekey": 3, "pass": 3, "cred": 3, "creds": 3, "cookie": 3, "cookies": 3,
    "auth": 3, "authorization": 3, "accesskey": 3, "secretkey": 3, "sshkey": 3, "sessionkey": 3, "bearer": 2,
    "key": 1, "access": 1, "api": 2, "private": 2, "signing": 2, "encryption": 2, "client": 1, "session": 1,
    "connection": 1, "webhook": 1, "salt": 2, "pin": 1, "mnemonic": 3, "seed": 2, "recovery": 2, "phrase": 1,
    "public": -4, "name": -3, "count": -4, "length": -4, "max": -3, "min": -3, "limit": -4, "type": -3,
    "field": -3, "label": -3, "path": -3, "file": -3, "url": -2, "id": -2, "expiry": -4, "ttl": -4,
    "placeholder": -4, "example": -4, "hint": -4, "prompt": -4, "policy": -4, "regex": -4, "pattern": -4,
}
#: Words that make a key in the same name a secret one: ``ssh_key``, not ``sort_key``.
KEY_OF = {"access", "account", "admin", "aes", "client", "deploy", "encryption", "gpg", "hmac", "host", "license", "master",
          "pgp", "root", "rsa", "server", "service", "session", "shared", "signing", "ssh", "ssl", "storage", "tls", "webhook"}
SENSITIVE = 3
MIN_LENGTH, MIN_DISTINCT = 8, 5
_WORDS = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|[0-9]+")
#: Literals that stand for a secret: whole ones, masks included, or with a whole
#: word that says so where all words are plain (``your-password-1``).
_PLACEHOLDER = re.compile(r"<[^<>]*+>|\*{3,}+\w{0,4}|x{3,}+\w{0,4}", re.I | re.ASCII)
_PLACEHOLDER_WORD = re.compile(r"(?:your|my|change|changeme|example|dummy|sample|placeholder|redacted|none|null|todo|x{3,})[0-9]{0,4}", re.I)
_PLAIN_WORD = re.compile(r"(?:[a-z]+|[A-Z]+|[A-Z][a-z]+)[0-9]{0,4}|[0-9]{1,4}")


def placeholder(text: str) -> bool:
    words = re.findall(r"[^\W_]+", text)
    return _PLACEHOLDER.fullmatch(text) is not None or (
        any(_PLACEHOLDER_WORD.fullmatch(w) for w in words) and all(_PLAIN_WORD.fullmatch(w) for w in words))


#: Words before a token in a header's value.
_SCHEMES = {"bearer", "basic", "token", "apikey", "digest", "negotiate"}
#: Words of sentences; a passphrase holds none, nor any that NAME_SCORES has.
_SENTENCE_WORDS = set("""a about after all also an and any are as at be before but by can contain do does enter for from has have here if in into
    invalid is it its least may missing must new no not of on one only or our please required set should so some than that the their then there
    these they this to too two type use used user using valid value was we when will with wrong you your""".split())


def strong(text: str) -> bool:
    """Holds a digit or letters of both cases, and is no placeholder."""
    return (any(c.isdigit() for c in text) or (text.lower() != text and text.upper() != text and not text.istitle())) and not placeholder(text)


def spaced_secret(text: str) -> bool:
    """Whether a literal with blanks in it is a secret.

    A private key; a scheme and a strong token; one strong token folded over
    several lines; or a passphrase: 4 to 24 different words of 3 or more small
    letters, parted by single spaces, none a word of sentences or of secrecy.
    """
    if "-----BEGIN " in text and "PRIVATE KEY" in text:
        return True
    words = text.split()
    if "\n" in text:
        return bool(words) and len(words) <= text.count("\n") + 1 and all(len(line.split()) < 2 for line in text.split("\n")) and strong("".join(words))
    if len(words) == 2 and words[0].lower() in _SCHEMES:
        return len(words[1]) >= MIN_LENGTH and strong(words[1])
    return 4 <= len(words) <= 24 and " ".join(words) == text and len(set(words)) == len(words) and all(
        len(w) > 2 and w.isascii() and w.isalpha() and w.islower() and w not in _SENTENCE_WORDS and w not in NAME_SCORES for w in words)


def name_score(name: str) -> int:
    """How sensitive a target's name is: the sum over its distinct words."""
    last = next((x for x in reversed(re.split(r"[.\[\]]", name)) if _WORDS.search(x) and not x.isdigit()), name)
    words = {w.lower() for w in _WORDS.findall(last)}
    return sum(NAME_SCORES.get(w, 0) for w in words) + (2 if "key" in words and words & KEY_OF else 0)


# --- values -----------------------------------------------------------------

@dataclass(eq=False)
class Value:
    """A literal (with its span) or a sum of values; measured, never joined."""

    length: int
    letters: int  # which characters occur, as a bit set of their low 7 bits
    mixed: bool   # holds a digit or a letter of each case, or is a passphrase
    span: tuple[int, int] | None = None
    parts: list[Value] = field(default_factory=list)
    told: bool = False  # all its spans are already reported

    @classmethod
    def literal(cls, text: str, start: int, end: int) -> Value:
        letters = 0
        for c in set(text):
            letters |= 1 << (ord(c) & 127)
        spaced = any(c in text for c in " \t\n")
        return cls(len(text), letters, spaced_secret(text) if spaced else strong(text), (start, end))

    @classmethod
    def sum(cls, parts: list[Value]) -> Value:
        if len(parts) == 1:
            return parts[0]
        out = cls(0, 0, False, None, parts)
        for p in parts:
            out.length = min(out.length + p.length, 1 << 40)
            out.letters |= p.letters
            out.mixed |= p.mixed
        return out

    @property
    def secret(self) -> bool:
        return self.length >= MIN_LENGTH and self.letters.bit_count() >= MIN_DISTINCT and self.mixed

    def tell(self, out: list[tuple[int, int]]) -> None:
        """Adds the spans of all literals in it that are not yet reported."""
        stack = [self]
        while stack:
            v = stack.pop()
            if v.told:
                continue
            v.told = True
            if v.span:
                out.append(v.span)
            stack.extend(v.parts)


# --- the lexer --------------------------------------------------------------

#: What starts a pair: an operator, a macro, or the tag of an element.
_EVENT = re.compile(r"""
    \#[ \t]*+define[ \t]++(?P<macro>[A-Za-z_]\w*+)(?=[ \t])
  | <(?P<tag>[A-Za-z_](?:[\w.\-]|:(?=\w))*+)(?=[\s/>])
  | :=?
  | =>?""", re.X)
_NAME_CHAR = re.compile(r"[A-Za-z0-9_.\-\]\[]")
_TERM = re.compile(r'''
    [ \t]*(?:
      (?P<prefix>[rbuf]{0,2})(?:"{3}(?P<tdq>(?:[^"\\]|\\[\s\S]|"(?!"{2}))*+)"{3}|'{3}(?P<tsq>(?:[^'\\]|\\[\s\S]|'(?!'{2}))*+)'{3}
        |"(?P<dq>(?:[^"\\\n]|\\.)*)"|'(?P<sq>(?:[^'\\\n]|\\.)*)'|`(?P<bq>[^`\n]*)`)
    | \$\{?(?P<ref>[A-Za-z_][A-Za-z0-9_.]*)\}?
    | (?P<bare>[A-Za-z0-9+/_.=\-~!@%^*]+)
    )''', re.X)
_JOIN = re.compile(r"[ \t]*(?:\+|\.\.|\|\|)(?![=+])[ \t]*")
#: A sum or a run of strings, over lines: inside parentheses, and where a string follows.
_QUOTE_NEXT = r"(?=[rbuf]{0,2}[\"'`])"
_JOIN_INSIDE = re.compile(rf"\s*+(?:\+|\.\.|\|\|)?+\s*+{_QUOTE_NEXT}")
_JOIN_LINES = re.compile(rf"\s*+(?:\+|\.\.|\|\|)\s*+{_QUOTE_NEXT}")
_OPEN = re.compile(rf"[ \t]*+\(\s*+{_QUOTE_NEXT}")
#: A string on the line after the operator; a key there is no value, three quotes may end a docstring.
_NEXT_LINE = re.compile(rf"[ \t]*+\\?\r?\n[ \t]*+(?!\"{{3}}|'{{3}}){_QUOTE_NEXT}")
_KEY_AFTER = re.compile(r"[ \t]*+(?::|=)")
_BLOCK = re.compile(r"[ \t]*+[|>][+\-0-9]{0,2}[ \t]*+(?:\#[^\n]*+)?+\r?\n")
_INDENT = re.compile(r"[ \t]*+")
#: Several targets at the start of a statement, and values by commas.
_TARGETS = re.compile(r"""\s*+(?:(?:const|let|var|val|my|our|local|final)[ \t]++)?+[(\[]?+[ \t]*+
    ((?:\$?[A-Za-z_][\w.]*+[ \t]*+,[ \t]*+)++\$?[A-Za-z_][\w.]*+)[ \t]*+[)\]]?+[ \t]*+""", re.X)
_LIST = re.compile(r"[ \t]*+[(\[]")
_CALL = re.compile(r"[ \t]*+[A-Za-z_][\w.]*+\([^()\n]*+\)")
_COMMA = re.compile(r"[ \t]*+,")
_STATEMENT_END = re.compile(r"[ \t]*+[)\]]?+[ \t]*+(?:;|\#|//|\r?\n|\Z)")
#: After a tag's name: attributes, then the end of an empty element, or text and the end tag.
_TAG = re.compile(r"""(?P<attributes>(?:\s++[A-Za-z_][\w:.\-]*+\s*+=\s*+(?:"[^"<]*+"|'[^'<]*+'))*+)\s*+
    (?:/> | >\s*+(?P<cdata><!\[CDATA\[)?+(?P<text>[^<]*+)</(?P<close>[\w:.\-]++)\s*+> | >)""", re.X)
_ATTRIBUTE = re.compile(r"""([A-Za-z_][\w:.\-]*+)\s*+=\s*+(?:"([^"<]*+)"|'([^'<]*+)')""")
_KEY_ATTRIBUTES = ("key", "name", "property")
#: ``name=value`` inside a string, as connection strings and URLs hold them.
_INNER = re.compile(r"(?<![\w.\-])([A-Za-z_][\w.\-]*+)[ \t]*+=[ \t]*+([^;&\s\"'=][^;&\s\"']*+)")
_IDENTIFIER = re.compile(r"[A-Za-z_][A-Za-z0-9_.]*\Z")


#: A type between ':' and '=': ``str``, ``Optional[str]``, ``string | null``,
#: ``&'static str``, ``std::string``. Before an unspaced '=' only a string makes
#: it a type, since bare values may hold '='.
_PLAIN_TYPE = r"(?:&(?:'\w++[ \t]++)?+(?:mut[ \t]++)?+)?+\*?+[A-Za-z_]\w*+(?:(?:\.|::)[A-Za-z_]\w*+)*+(?>[\[<][^=\n:;]*[\]>])?+[?!]?+"
_TYPED = re.compile(rf"""[ \t]*+(?P<type>{_PLAIN_TYPE}(?:[ \t]*+\|[ \t]*+{_PLAIN_TYPE})*+)
    (?:[ \t]++=(?![=>~])(?=[ \t]*+(?P<quoted>[rbuf]{{0,2}}["'`])?)(?![ \t]*+(?:\n|\Z)) | =(?=[rbuf]{{0,2}}["'`]))""", re.X)
#: Types that follow a name without a colon (Go), and words that are no name.
_TYPES_AFTER = {"string", "byte", "rune", "any", "error", "bool", "int", "int64", "uint64", "float64"}
_KEYWORDS = {"var", "const", "let", "val", "def", "public", "private", "protected", "static", "final", "readonly", "my", "our", "local",
             "export", "type", "internal", "virtual", "override", "auto", "mut", "new", "return", "abstract", "extern", "volatile"}


def _word_before(text: str, end: int, since: int) -> tuple[str, int]:
    """The identifier before ``end``, blanks skipped, and where it starts."""
    while end > since and text[end - 1] in " \t":
        end -= 1
    start = end
    while start > since and (text[start - 1].isalnum() or text[start - 1] == "_"):
        start -= 1
    return text[start:end], start


def _name_before(text: str, at: int, since: int) -> str:
    """The assigned name that ends before an operator, quotes taken off.

    A quoted key in brackets gives ``["key``, which is no variable's name.
    """
    end = at
    while end > since and text[end - 1] in " \t":
        end -= 1
    if end > since and text[end - 1] == "\n":  # the name ends the line before
        end -= 1
        while end > since and text[end - 1] in " \t\r":
            end -= 1
    if end > since + 1 and text[end - 1] in "?!" and text[at] == ":" and _NAME_CHAR.match(text[end - 2]):
        end -= 1  # an optional member
    if end > since and text[end - 1] in "\"'`":
        end -= 1
    key = end
    while key > since and text[key - 1] == "]":
        close = key - 1
        while close > since and text[close - 1] in " \t":
            close -= 1
        if close > since and text[close - 1] in "\"'`":
            start = text.rfind(text[close - 1], since, close - 1)
            return '["' + text[start + 1:close - 1] if start > since else ""
        while close > since and text[close - 1].isdigit():
            close -= 1  # a[0]: what a is
        if close == since or text[close - 1] != "[":
            break
        key = close - 1
    start = end
    while start > since and _NAME_CHAR.match(text[start - 1]):
        start -= 1
    name = text[start:end].strip("-.")
    if text[at] == "=":
        while start > since and text[start - 1] == "*":
            start -= 1
        before, first = _word_before(text, start, since)
        if before and first < start and text[start - 1:start] in (" ", "\t", "*", "[") and not before[0].isdigit() and before not in _KEYWORDS:
            if name.replace("[]", "") in _TYPES_AFTER or _word_before(text, first, since)[0] == "var":
                return before
    return name


def _value(text: str, pos: int, known: dict[str, Value], inner: list[tuple[str, Value]]) -> tuple[Value | None, int]:
    """The constant at ``pos`` (None where there is none), and where it ends.

    Assignments inside its strings go to ``inner``.
    """
    opened = _OPEN.match(text, pos)
    folded = None if opened else _NEXT_LINE.match(text, pos)
    parts: list[Value] = []
    at, constant = (opened or folded).end() if opened or folded else pos, True
    while (term := _TERM.match(text, at)) is not None:
        kind = term.lastgroup if term.lastgroup != "prefix" else "dq"
        word, start, end = term[kind], *term.span(kind)
        at = term.end()
        if kind not in ("ref", "bare"):
            if kind in ("tdq", "tsq"):  # blank lines around the text are not part of it
                start, end = start + len(word) - len(word.lstrip()), end - len(word) + len(word.rstrip())
                word = text[start:end]
            parts.append(Value.literal(word, start, end))
            inner += ((m[1], Value.literal(m[2], start + m.start(2), start + m.end(2))) for m in _INNER.finditer(word))
        elif kind == "ref" or _IDENTIFIER.match(word) and (word in known or text[at:at + 1] in ("(", "[")):
            if word in known and text[at:at + 1] not in ("(", "["):
                parts.append(known[word])
            else:
                constant = False
        else:
            parts.append(Value.literal(word, start, end))
        more = opened and _JOIN_INSIDE.match(text, at) or kind not in ("ref", "bare") and _JOIN_LINES.match(text, at) or _JOIN.match(text, at)
        if not more:
            break
        at = more.end()
    if folded and _KEY_AFTER.match(text, at):
        return None, pos
    return (Value.sum(parts) if parts and constant else None), max(at, pos)


def _targets(text: str, at: int, since: int) -> list[str]:
    """The names of ``a, b = …``, where the statement begins with them; else none."""
    begin = max(text.rfind(";", since, at), text.rfind("\n", since, at)) + 1
    if begin == 0 and since > 0 or text.find(",", begin, at) < 0:
        return []
    found = _TARGETS.fullmatch(text, begin, at)
    return [name.strip().lstrip("$") for name in found[1].split(",")] if found else []


def _block(text: str, pos: int, indent: int) -> tuple[int, int, int]:
    """Start and end of a block's text, whose lines are set in beyond ``indent``, and where reading goes on."""
    start = end = -1
    least = indent + 1
    while pos < len(text):
        stop = text.find("\n", pos)
        stop = len(text) if stop < 0 else stop
        first = _INDENT.match(text, pos).end()
        line = text[first:stop].rstrip()
        if line:
            if first - pos < least:
                break
            if start < 0:
                start, least = first, first - pos
            end = first + len(line)
        pos = stop + 1
    return start, end, min(pos, len(text))


def _element(text: str, pos: int, tag: str) -> Iterator[tuple[str, Value]]:
    """Pairs of the element whose tag's name ends at ``pos``: of its text and its ``value`` attribute."""
    found = _TAG.match(text, pos)
    if found is None:
        return
    attributes = [(a[1].lower(), *(a.span(2) if a[2] is not None else a.span(3)))
                  for a in _ATTRIBUTE.finditer(text, *found.span("attributes"))]
    names = [tag.rpartition(":")[2], *(text[start:end] for key, start, end in attributes if key in _KEY_ATTRIBUTES)]
    for key, start, end in attributes:
        if key == "value":
            yield from ((name, Value.literal(text[start:end], start, end)) for name in names)
    if found["close"] == tag:
        word = found["text"].rstrip()
        if found["cdata"] and word.endswith("]]>"):
            word = word[:-3].rstrip()
        start = found.end("text") - len(found["text"].lstrip())
        word = word.lstrip()
        yield from ((name, Value.literal(word, start, start + len(word))) for name in names)


def pairs(text: str) -> Iterator[tuple[str, Value]]:
    """(target name, value) for every assignment of constants, in order."""
    known: dict[str, Value] = {}
    pos = since = 0

    def assigned(name: str, value: Value) -> tuple[str, Value]:
        known[name.rsplit(".", 1)[-1]] = known[name] = value
        return name, value

    while (op := _EVENT.search(text, pos)) is not None:
        pos = op.end()
        inner: list[tuple[str, Value]] = []
        if op["tag"]:
            yield from _element(text, pos, op["tag"])
            continue
        if op["macro"]:
            value, pos = _value(text, pos, known, inner)
            since = pos
            yield from inner
            if value:
                yield assigned(op["macro"], value)
            continue
        if text[pos:pos + 1] == "=" or op.start() and text[op.start() - 1] in "!<>=+-*/%|&":
            pos = since = pos + (text[pos:pos + 1] == "=")  # a comparison or an update
            continue
        if op[0] == ":" and text[op.start() - 1:op.start()] == "[":
            continue  # a symbol as key, or a slice
        before, since = since, pos
        name = _name_before(text, op.start(), before)
        names = _targets(text, op.start(), before) if op[0] in ("=", ":=") else []
        if not names and not (name[:1].isalpha() or name[:1] == "_" or name.startswith('["')):
            continue
        line = text.rfind("\n", before, op.start()) + 1
        if op[0] == ":" and name_score(name) >= SENSITIVE and (line or not before) and (mark := _BLOCK.match(text, pos)) is not None:
            indent = len(re.match(r"[ \t]*+(?:-[ \t]++)*+", text[line:op.start()])[0])
            start, end, pos = _block(text, mark.end(), indent)
            since = pos
            if start >= 0:
                yield assigned(name, Value.literal(text[start:end], start, end))
            continue
        if op[0] == ":" and (typed := _TYPED.match(text, pos)) is not None:
            word = typed["type"]
            # A bare value that looks like a secret is no type, unless a string follows.
            if typed["quoted"] or text[typed.end() - 2] not in " \t" or not Value.literal(word, 0, 0).secret:
                pos = typed.end()
        first = pos
        if names and (list_of := _LIST.match(text, pos)) is not None:
            first = list_of.end()
        value, pos = _value(text, first, known, inner)
        if names:
            values, at = [value], pos
            if value is None and (call := _CALL.match(text, first)) is not None:
                at = call.end()
            while len(values) < len(names) and (comma := _COMMA.match(text, at)) is not None:
                if (call := _CALL.match(text, comma.end())) is not None:
                    one, at = None, call.end()
                else:
                    one, at = _value(text, comma.end(), known, inner)
                    if at == comma.end():
                        break
                values.append(one)
            if len(values) == len(names) and _STATEMENT_END.match(text, at):
                pos = since = at
                yield from inner
                yield from [assigned(n, v) for n, v in zip(names, values) if v]
                continue
            if text[op.start() - 1] in " \t":  # not arguments of a call: nothing is known to reach a name
                value = None
        since = pos
        yield from inner
        # An operator that begins its line takes a string alone.
        begin = _INDENT.match(text, first).end()
        if value and (_INDENT.match(text, max(line, before)).end() < op.start() or text[begin:begin + 1] in ('"', "'", "`")):
            yield assigned(name, value)


def pair_spans(text: str) -> list[tuple[int, int]]:
    """Where the literals stand that reach sensitive names."""
    if not any(mark in text for mark in (":", "=", "</", "define")):
        return []
    out: list[tuple[int, int]] = []
    scores: dict[str, int] = {}
    for name, value in pairs(text):
        score = scores.get(name)
        if score is None:
            score = scores[name] = name_score(name)
        if score >= SENSITIVE and value.secret:
            value.tell(out)
    return out


def secret_spans(text: str | None) -> list[tuple[int, int, str]]:
    """All spans by start, then kind. A pair inside a base span or another pair adds nothing."""
    base = base_spans(text or "")
    spans = sorted(base, key=lambda s: (s[0], KINDS.index(s[2])))
    if extra := pair_spans(text or ""):
        cover, i, reach = sorted(base), 0, -1
        for start, end in sorted(set(extra), key=lambda s: (s[0], -s[1])):
            while i < len(cover) and cover[i][0] <= start:
                reach = max(reach, cover[i][1])
                i += 1
            if end > reach:
                spans.append((start, end, "pair"))
                reach = end
        spans.sort(key=lambda s: (s[0], KINDS.index(s[2])))
    return spans


def scan(docs: DataFrame) -> DataFrame:
    """(doc_id, spans array of (start, end, kind)) for every row of ``docs``.

    Offsets are code points, end exclusive; spans are in order of start, kind.
    """
    item = pa.struct([("start", pa.int64()), ("end", pa.int64()), ("kind", pa.string())])
    schema = pa.schema([("doc_id", pa.int64()), ("spans", pa.list_(item))])

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            spans = [[{"start": a, "end": b, "kind": k} for a, b, k in secret_spans(t.as_py())] for t in part.column(1)]
            yield pa.record_batch([part.column(0), pa.array(spans, schema.field("spans").type)], schema=schema)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        run, "doc_id long, spans array<struct<start:bigint,end:bigint,kind:string>>")
