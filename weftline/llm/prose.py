"""The running text of articles in typesetting markup, as it would be typeset."""

from __future__ import annotations

import re

import numpy as np

#: Accent commands and the combining marks they set.
ACCENTS = {"'": "\u0301", "`": "\u0300", "^": "\u0302", '"': "\u0308", "~": "\u0303", "=": "\u0304", ".": "\u0307", "c": "\u0327", "v": "\u030c", "u": "\u0306", "H": "\u030b", "r": "\u030a", "k": "\u0328"}
#: Letters with a name.
LETTERS = {"ss": "ß", "ae": "æ", "AE": "Æ", "oe": "œ", "OE": "Œ", "o": "ø", "O": "Ø", "aa": "å", "AA": "Å", "l": "ł", "L": "Ł", "i": "i", "j": "j"}

BREAK = "\x00"
_COMMENT_LINE = re.compile(r"^[ \t]*%.*\n?", re.M)
_COMMENT = re.compile(r"%(?<!\\%).*")
_HIDDEN = re.compile(r"\\iffalse\b.*?(?:\\fi\b|\Z)|\\begin\s*\{comment\}.*?(?:\\end\s*\{comment\}|\Z)", re.S)
_BIBLIOGRAPHY = re.compile(r"\\begin\s*\{thebibliography\}.*?(?:\\end\s*\{thebibliography\}|\Z)|\\bibitem(?:[^\n]|\n(?!\s*\n))*", re.S)
_MACRO = re.compile(r"\\(?:(?:re)?newcommand|providecommand)\*?\s*\{?\\([A-Za-z]+)\}?\s*\{([^{}\\$]+)\}|\\def\s*\\([A-Za-z]+)\s*\{([^{}\\$]+)\}")
_DEFINITION = re.compile(r"\\(?:(?:re)?newcommand|providecommand|def|newtheorem|DeclareMathOperator|let)\b.*")
_DISPLAY = re.compile(r"\\begin\s*\{(equation|align|eqnarray|gather|multline|displaymath|math|tabular|verbatim|tikzpicture|array)(\*?)\}.*?\\end\s*\{\1\2\}|\$\$(?:[^$]|\\\$)*?\$\$|\\\[.*?\\\]", re.S)
_INLINE = re.compile(r"\$(?<!\\\$)[^$\n]*(?:\n(?![ \t]*\n)[^$\n]*)*\$")
_PAREN = re.compile(r"\\\((?:[^\n]|\n(?![ \t]*\n))*?\\\)")
_ARG = r"\{(?:[^{}]|\{(?:[^{}]|\{[^{}]*\})*\})*\}"
_HEADING = re.compile(r"\\(?:title|author|date|part|chapter|(?:sub)*section|(?:sub)?paragraph|thanks|affiliation|address|email|keywords)\b\*?\s*(?:\[[^\]]*\])?\s*" + _ARG)
_CAPTION = re.compile(r"\\caption\*?\s*(?:\[[^\]]*\])?\s*\{((?:[^{}]|\{(?:[^{}]|\{[^{}]*\})*\})*)\}")
_ASIDE = re.compile(r"\\footnote(?:text)?\s*(?:\[[^\]]*\])?\s*" + _ARG)
_DROP = re.compile(r"\\(?:cite[a-z]*|ref|eqref|autoref|pageref|label|input|include|subfile|includegraphics|bibliography|bibliographystyle|usepackage|documentclass|documentstyle|color|vspace|hspace|url|href|index|setlength|pagestyle|thispagestyle)\b\*?\s*(?:\[[^\]]*\])?(?:\{[^{}]*\})*")
_ENVIRONMENT = re.compile(r"\\(begin|end)\s*\{[^}]*\}(?:\[[^\]]*\])?|\\(?:item|maketitle|appendix|tableofcontents|newpage|clearpage|par)\b")
_ACCENT = re.compile(r"\\(?:([\"'`^~=.])\s*(?:\{\s*(?:\\([ij])(?![A-Za-z])\s*|([^\W\d_]))\s*\}|\\([ij])(?![A-Za-z])\s?|([^\W\d_]))|([cvuHrk])\s*\{\s*(?:\\([ij])\s*|([^\W\d_]))\s*\}|([cvuHrk])\s+([^\W\d_]))")
_LETTER = re.compile(r"\\(ss|ae|AE|oe|OE|aa|AA|o|O|l|L|i|j)(?![A-Za-z])(?:\{\}|\s)?")
_COMMAND = re.compile(r"\\[A-Za-z]+\*?\s?|\\.")
#: What may stand in a quotation: it ends with its paragraph at the latest.
_WITHIN = r"[^{0}\n\x00]*(?:\n(?![ \t]*\n)[^{0}\n\x00]*)*"
#: Opening and closing marks of quotations.
_QUOTED = {
    "``": re.compile(r"``(?:[^`'\n\x00]|'(?!')|\n(?![ \t]*\n))+''"),
    "„": re.compile("„" + _WITHIN.format("“”") + "[“”]"),
    "«": re.compile("«" + _WITHIN.format("»") + "»"),
    "“": re.compile("“" + _WITHIN.format("”") + "”"),
    '"': re.compile(r"\"(?<!\w\")" + _WITHIN.format('"') + '"'),
}
_SENTENCES = re.compile(r"[.!?]\s+\S.*[.!?]\s*\S*$", re.S)
_BRACES, _TIE, _EMPTY = re.compile(r"[{}]"), re.compile("~"), re.compile(r"\[\]")


class Plain:
    """A text under substitution."""

    def __init__(self, text: str):
        self.text = text

    def sub(self, pattern: re.Pattern, new="") -> None:
        self.text = pattern.sub(new, self.text)

    def cut(self, a: int, b: int) -> None:
        self.text = self.text[a:b]

    def take(self, pattern: re.Pattern) -> list:
        """Removes the matches, leaves BREAK in their place and returns their first groups."""
        found = pattern.findall(self.text)
        self.sub(pattern, BREAK)
        return found

    def add(self, parts: list) -> None:
        self.text += "".join(BREAK + p for p in parts)


class Placed(Plain):
    """The same with each sign's place in the source: `starts` and `ends`, counted in signs, the end not included."""

    def __init__(self, text: str):
        super().__init__(text)
        self.starts = np.arange(len(text))
        self.ends = self.starts + 1

    def sub(self, pattern: re.Pattern, new="") -> None:
        text, at, out, starts, ends = self.text, 0, [], [], []
        for m in pattern.finditer(text):
            a, b = m.span()
            put = new(m) if callable(new) else new
            if put == m[0]:
                continue
            out += text[at:a], put
            starts += self.starts[at:a], np.full(len(put), self.starts[a])
            ends += self.ends[at:a], np.full(len(put), self.ends[b - 1])
            at = b
        if out:
            self.text = "".join([*out, text[at:]])
            self.starts, self.ends = np.concatenate([*starts, self.starts[at:]]), np.concatenate([*ends, self.ends[at:]])

    def cut(self, a: int, b: int) -> None:
        super().cut(a, b)
        self.starts, self.ends = self.starts[a:b], self.ends[a:b]

    def take(self, pattern: re.Pattern) -> list:
        found = [(m[1], self.starts[slice(*m.span(1))], self.ends[slice(*m.span(1))]) for m in pattern.finditer(self.text)]
        self.sub(pattern, BREAK)
        return found

    def add(self, parts: list) -> None:
        for text, starts, ends in parts:
            mark = ends[-1:] if len(ends) else self.ends[-1:]
            self.text += BREAK[: len(mark)] + text
            self.starts, self.ends = np.concatenate([self.starts, mark, starts]), np.concatenate([self.ends, mark, ends])


def _accent(m: re.Match) -> str:
    import unicodedata

    g = m.groups()
    mark = ACCENTS[g[0] or g[5] or g[8]]
    return unicodedata.normalize("NFC", (g[1] or g[2] or g[3] or g[4] or g[6] or g[7] or g[9]) + mark)


def _quoted(m: re.Match) -> str:
    # a passage of sentences in quotation marks is text; a term is not
    return m[0] if _SENTENCES.search(m[0]) else " "


def _without_terms(t: Plain) -> Plain:
    for mark, pattern in _QUOTED.items():
        if mark in t.text:
            t.sub(pattern, _quoted)
    return t


def typeset(t: Plain) -> Plain:
    """The running text of t, which is changed, with BREAK where headings, captions and bibliographies cut the flow. Formulas are left out.

    Comments, hidden drafts, preambles, bibliographies, headings, quoted terms and footnote marks go; captions are
    parts of their own at the end; accents in markup become letters; macros that stand for words are replaced.
    Broken markup keeps what cannot be told from text.
    """
    if "%" in t.text:
        t.sub(_COMMENT_LINE)
        t.sub(_COMMENT)
    if "\\" not in t.text and "$" not in t.text:
        return _without_terms(t)
    if "\\iffalse" in t.text or "{comment}" in t.text:
        t.sub(_HIDDEN, " ")
    head, at = "", t.text.find("\\begin{document}")
    if at >= 0:
        head = t.text[:at]
        t.cut(at + 16, len(t.text))
    if (end := t.text.find("\\end{document}")) >= 0:
        t.cut(0, end)
    if "\\bibitem" in t.text or "{thebibliography}" in t.text:
        t.sub(_BIBLIOGRAPHY, BREAK)
    for a, x, b, y in _MACRO.findall(head or t.text):
        if (name := a or b) and " " in (words := x or y) and "\\" + name in t.text:
            t.sub(re.compile(r"\\" + name + r"(?![A-Za-z])\s?"), lambda _, w=words: w + " ")
    if not head:
        t.sub(_DEFINITION)
    t.sub(_DISPLAY, " ")
    if "$" in t.text:
        t.sub(_INLINE, " ")
    if "\\(" in t.text:
        t.sub(_PAREN, " ")
    tail = t.take(_CAPTION) if "\\caption" in t.text else []
    if "\\footnote" in t.text:
        t.sub(_ASIDE)
    t.sub(_HEADING, BREAK)
    t.add(tail)
    t.sub(_DROP)
    t.sub(_ENVIRONMENT, " ")
    if "\\" in t.text:
        t.sub(_ACCENT, _accent)
        t.sub(_LETTER, lambda m: LETTERS[m[1]])
        t.sub(_COMMAND, " ")
    t.sub(_BRACES)
    t.sub(_TIE, " ")
    t.sub(_EMPTY)
    return _without_terms(t)


def prose(text: str | None) -> str:
    """The running text (see typeset); null gives ""."""
    return typeset(Plain(text)).text if text else ""
