"""Unfilled template fields, filler, error messages and script notices that stand in place of content.

Each kind of placeholder has the grammar of its delimiters. A match counts only where content should be: not
in code, formulas or quotation, nor in a sentence that speaks about templates. Notices and messages count
where a line, a sentence or an element begins with them, which a text about them doesn't do.
"""

from __future__ import annotations

import bisect
import functools
import operator
from collections.abc import Iterator

import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KINDS = ("placeholder", "filler", "error", "notice")

#: A template's name for a field; it ends where the closing delimiter must stand, so it is never taken back.
NAME = r"[A-Za-z][\w.\- ]*+"
#: Placeholders by delimiter: what must not stand before, the opening delimiters (each a literal, upper case where it
#: must be), and the rest. A grammar names what stands between the delimiters, so set braces, wiki links, elements of
#: HTML and operators are none of them. Names may have any length.
GRAMMARS: dict[str, list[tuple[str, list[str], str]]] = {
    "mustache": [("", ["{{"], rf"\{{?\s*[#^/&>!]?\s*{NAME}(?:\|[^{{}}\n]++)?\s*\}}?\}}\}}")],
    "statement": [("", ["{%"], r"-?\s*(?:if|for|else|elif|endif|endfor|block|include|set|extends)\b[^%\n]*+%\}")],
    "erb": [("", ["<%"], r"[=\-]?\s*[\w.@\[\]'\"() ]++-?%>")],
    "shell": [(r"(?<![\\$\w])", ["${"], r"[A-Za-z_][\w.]++\}(?!\$)")],
    "printf": [("", ["%("], r"[A-Za-z_]\w*+\)[sdfr]")],
    "format": [(r"(?<![\\\w}\]_^$&={(])", ["{"], r"(?:[A-Za-z][A-Za-z_]{2,}+|\d{1,2})\}(?![\w{$^_])")],
    "dunder": [(r"(?<!\w)", ["__"], r"[A-Z][A-Z0-9_]*[A-Z0-9]__(?!\w)")],
    "at": [("", ["@@"], r"[A-Za-z]\w++@@")],
    "bracket": [("", ["[["], r"[A-Z][A-Z0-9_ ]{2,}+\]\]")],
    "angle": [("", ["<"], r"(?!HTML|BODY|HEAD|TITLE>|DIV|SPAN|NOSCRIPT|SCRIPT|TABLE|STYLE|IMG|CODE|PRE|SUB|SUP|BR)[A-Z][A-Z_]{2,}+>|<TITLE>(?!.*</TITLE>)|<(?:insert|your|enter|INSERT|YOUR|ENTER)[ _][A-Za-z _]{2,}+>")],
    "entity": [("", ["&lt;"], r"[a-z][a-z_ ]{2,}+&gt;")],
    "guillemet": [("", ["«"], r"[a-z]{3,}+(?:[ _][a-z]{2,}+){0,2}»")],
    "dollar": [("", ["$$"], r"[A-Z][A-Z_]{2,}+\$\$")],
    "percent": [(r"(?<![\w%])", ["%"], r"[A-Z][A-Z_]{2,}+%(?![\w%])"), (r"(?<![\w#])", ["#"], r"#?[A-Z][A-Z_]{2,}+##?(?![\w#])")],
    "instruction": [
        ("", ["[INSERT ", "[ENTER ", "[ADD ", "[TYPE ", "[FILL IN ", "[Insert ", "[Enter ", "[Add ", "[Fill in "], r"[\w ,'\-]{2,}+\]"), ("", ["[Your ", "[your "], r"[\w \-]{2,}+\]"),
        ("", ["["], r"[\w \-]{2,} goes here\]"), ("", ["(add ", "(insert ", "(fill in "], r"[\w \-]{2,}+\)"),
    ],
    "todo": [(r"\b", ["TODO", "FIXME"], r"\s*:\s*(?:fill|add|insert|write|complete)[^\n.;]*+"), (r"\b", ["TBD"], r"\b(?:\s*[-–:]\s*[\w ]{2,}+)?"), (r"\b", ["XXXX"], r"X*\s*\([\w ]{2,}+\)")],
    "comment": [("", ["<!--"], r"\s*[\w ]{2,}\bplaceholder\s*-->|<!--\s*(?:insert|todo|add)\b[^>\n]*?-->")],
    "object": [("", ["[object"], r" Object\]")],
}


def _rules() -> Iterator[tuple[str, str, str]]:
    """(kind, opening delimiter, pattern) of every rule; a rest that names the delimiter again is an alternative."""
    for kind, rules in GRAMMARS.items():
        for before, opens, rest in rules:
            for o in opens:
                first, *others = rest.split(f"|{o}")
                yield kind, o, f"{before}{regex.escape(o)}(?:{first})"
                yield from ((kind, o, f"{before}{regex.escape(o)}(?:{x})") for x in others)


PLACEHOLDER = regex.compile("|".join(p for _, _, p in _rules()))
BY_OPENER: dict[str, list[tuple[str, regex.Pattern]]] = {}
for _kind, _open, _pattern in _rules():
    BY_OPENER.setdefault(_open.lower(), []).append((_kind, regex.compile(_pattern)))
#: A value that a program left out, where a field should be.
MISSING = regex.compile(r"^\W*(?:[\w ]+:\s*)?(?:undefined|NaN)\W*$|(?:^\W*|[.!?]\s+)(?:as|see|cf\.?|by|in|from|following)\s+(?:undefined|NaN)\b|\b(?:by|on|of|reports?|extends?|studies|chapter,|keywords:|title:|authors?:)\s+(?:undefined|NaN)\b(?!\s+(?:if|when|unless|for|at|outside|behaviou?r))", regex.I)
#: A sentence with one of these speaks about templates, unless the placeholder is all there is.
SPEAKS = regex.compile(
    r"\b(?:macros?|variables?|placeholders?|templates?|render(?:s|ed|ing)?|listings?|expand(?:s|ed)?|replac(?:e[sd]?|ing)|substitut\w+|syntax|escap(?:e[sd]?|ing)|literal(?:ly)?|regular expressions?|singleton|python|jinja|mustache|handlebars|"
    r"xml|html|schema|style|notation|denotes?|called|label|abbreviation|strings?|tokens?|delimiters?|curly|braces?|column|command|function|call|manual|misled|the sets?|is even|values? of|written as|stands? for|engine|parser|logs?|shell|printf?)\b",
    regex.I,
)
CODE = regex.compile(r"(?ms)^[ \t]*(```|~~~).*?(?:^[ \t]*\1[ \t]*$|\Z)|^(?: {4}|\t)\S.*$|\\begin\{(verbatim|lstlisting|minted)\}.*?\\end\{\2\}")
SPANS = regex.compile(r"`[^`\n]+`|(?<!\$)\$(?!\$)(?!\{)[^$\n]+\$(?!\$)|\\[(\[].*?\\[)\]]|[\"“„][^\"”“\n]++[\"”]|(?<!\w)'[^'\n]{2,80}'(?!\w)")

LOREM = frozenset(
    "lorem ipsum dolor sit amet consectetur adipiscing elit sed do eiusmod tempor incididunt ut labore et dolore magna aliqua enim ad minim veniam quis nostrud exercitation ullamco laboris nisi aliquip ex ea commodo consequat duis aute irure in "
    "reprehenderit voluptate velit esse cillum eu fugiat nulla pariatur excepteur sint occaecat cupidatat non proident sunt culpa qui officia deserunt mollit anim id est laborum".split()
)
THING = r"(?:the |this |that |full |an? )?(?:page|article|record|pdf|preprint|item|chapter|supplement|dataset|full text|text|paper|document|content|file|resource|url|link|site|app|viewer|entry|abstract|book|report|reader)s?"
STATUS = r"(?:not found|bad request|forbidden|gone|unauthori[sz]ed|(?:bad )?gateway(?: time-?out)?|service (?:temporarily )?unavailable|(?:internal )?server error|too many requests|request time-?out|not acceptable|moved permanently)"
#: Where a sentence begins; tags have been blanked out.
SENTENCE = regex.compile(r"[.!?…:]\s+|[。！？]|\s{3,}")

FILLER = regex.compile(
    r"(?:sample text[.!]|lorem ipsum\W*$|(?:body )?copy to follow|content (?:is )?coming soon|(?:this is )?(?:a )?(?:placeholder|dummy|filler) (?:paragraph|text)[.!]|(?:double-)?click (?:here )?to (?:edit|add|change) (?:this )?(?:text|title|content)|(?:your|insert|enter|add|type) (?:your )?text (?:goes )?here|replace this (?:text|paragraph) with|"
    r"text to be (?:supplied|added|provided)|to be (?:written|completed)[.!]?\W*$|hier steht (?:(?:ihr|der|ein|dieser) )?(?:\w*text)\b|(?:dies ist (?:ein )?)?(?:blind|füll|platzhalter|beispiel)text\b|(?:ceci est )?(?:un |du )?(?:faux )?texte? (?:de remplissage|à venir|d['’]exemple|provisoire|factice)|(?:(?:este|esto) es )?(?:un )?texto de (?:relleno|ejemplo|prueba|muestra)|contenido próximamente|contenu à venir|inhalt folgt|内容即将|此处(?:填写|输入)|示例文本)",
    regex.I,
)
#: One word, and one sentence, over and over.
STUTTER = regex.compile(r"\b([a-z]{2,12})\b(?:[\s,.]+\1\b){6,}|\bx{3,}(?:\s+x{3,}\b){3,}")
#: What hands type that write nothing.
MASH = frozenset("asdf asdfg asdfgh jkl jklö sdf qwer qwert qwerty zxcv zxcvb foo bar baz qux test blah bla xxx".split())
TYPED = LOREM | MASH
LEAST_REPEATS = 4
NOTICE = regex.compile(
    r"(?:(?:please |you (?:need|have) to |you must |to [^.\n]{3,60}, (?:please |you (?:need|have) to )?)?(?:enable|activate|allow|turn on|switch on|accept)\b[^.\n\"]{0,40}?\b(?:java ?scripts?|scripts?|scripting|cookies)\b(?=[^\"”]*$|[^\"”]*[.!])|"
    r"turn it on in your settings|you need (?:script support|java ?script|to enable)|"
    rf"(?:this |the )[\w ]{{2,40}}(?:requires?|needs?) [^.\n]{{0,40}}(?:java ?script|script(?:s|ing)?|a (?:modern|newer|recent) browser|cookies)\b|"
    r"java ?script (?:is|must be|has to be|seems to be|appears to be) (?:not available|not enabled|unavailable|disabled|required|turned off|switched off|off|enabled|needed|on)|"
    r"interactive [\w ]{2,30}: no preview|loading (?:the )?\w*\s?(?:…|\.\.\.)|"
    r"(?:les |las |die |the )?cookies (?:must|have to|need to|are required|should|doivent|deben|müssen|sont (?:nécessaires|requis)|son necesarias|sind erforderlich)\b|your browser (?:is out ?of ?date|is outdated|is (?:not|no longer) supported|does ?n[o']t support|cannot|can't|must|has (?:java ?script|cookies))|"
    r"it (?:looks as if|looks like|seems|appears)[^.\n]{0,12} (?:an?|your) [^.\n]{0,30}blocker|(?:please )?(?:disable|turn off|pause) your (?:ad|script)|"
    r"checking (?:your|if the|the) (?:browser|connection|site connection)|one moment(?:, please)?,? (?:while )?we(?: are|'re)? (?:verify|check)\w*|(?:please )?(?:confirm|verify|prove) (?:that )?you are (?:not a robot|(?:a )?human)|"
    r"bitte (?:aktivieren|erlauben|schalten) sie\b|(?:veuillez )?(?:activer|activez|autorisez) (?:le |les )?(?:java ?script|scripts|cookies)|(?:por favor,? )?(?:active|habilite|permita) (?:el |las |los )?(?:java ?script|scripts|cookies)|"
    r"(?:ihr|su|votre) (?:browser|navegador|navigateur) (?:wird geprüft|ist veraltet|unterstützt|no admite|no es compatible|está (?:desactualizado|obsoleto)|ne (?:prend|permet|peut)|est (?:obsolète|trop ancien))|"
    r"(?:comprobando|vérification de|überprüfung) (?:su|votre|ihres) (?:navegador|navigateur|browsers)|请(?:启用|开启|允许|打开)|(?:您的|你的)?浏览器(?:不支持|版本过低|已过期)|正在(?:检查|验证)(?:您|你)?)",
    regex.I,
)
ERROR = regex.compile(
    rf"(?:(?:http )?(?:status |error |code )?[1-9]\d\d\s*[-–:]?\s*{STATUS}\b|{STATUS}\s*(?:[.!(:]|$|\W*(?:request|ray|proxy|error|please|reload|contact))|http (?:status|error) \d{{3}}\b|(?:error|erreur|fehler)\s*(?:code )?\d{{3}}\s*(?:[-–:.(]|$)|"
    r"page (?:not found|introuvable)\b(?! errors)\s*(?:[.!:(]|$)|página no encontrada|seite nicht gefunden|找不到(?:您|你)?请求|"
    r"access denied\s*(?:[.!:]|$)|acceso denegado|accès refusé|zugriff verweigert|访问被拒绝|"
    rf"(?:sorry, )?{THING} (?:that )?you (?:asked for|requested|are looking for|were looking for|tried to open|want) (?:is|are|was|has|have|could|can|does|do|no)\b|{THING} (?:is|are) (?:not|no longer|temporarily|currently) (?:available|unavailable|accessible)\b|"
    r"your request (?:was|has been|could not be) (?:blocked|denied|rejected|refused|completed)|your session (?:has )?(?:timed out|expired|ended)|rate limit (?:exceeded|reached)|too many requests\s*[.!]|"
    r"the (?:server|site|service|gateway|database) (?:took too long|did not respond|is (?:down|busy|temporarily|currently|not responding|unavailable|overloaded)|encountered|returned an error)|(?:scheduled|planned|routine) maintenance\s*[.!:]|(?:we are|we're|the site is) (?:currently )?(?:down|offline|under) (?:for )?maintenance|"
    rf"(?:sorry, |oops[!,.]? )?we (?:can ?not|can't|could not|couldn't|are unable to|were unable to) (?:find|retrieve|locate|load|open|display|show|serve|process) (?:{THING}|your request)|"
    rf"(?:unable|failed) to (?:open|load|retrieve|display|connect|fetch|render)\b|download (?:failed|error)\b|could not (?:connect|open|load|resolve)\b|fatal(?: error)?: |(?:uncaught |unhandled )?(?:type|reference|syntax|runtime)?(?:error|exception): |traceback \(most recent|nosuch(?:key|bucket)\b|(?:key|value|type|name|index|attribute|import|runtime|os|io|connection|timeout)error: |"
    rf"nothing (?:here|to see here|was found)\s*[.!]|subscription required|(?:you have|you've) (?:reached|exceeded|used up) (?:your|the) (?:\w+ )?(?:limit|quota)|you (?:do not|don't) have (?:permission|access|the rights?)|(?:please )?(?:log|sign) in (?:again )?to (?:continue|view|read|access)|(?:connection|request|operation|session) (?:refused|reset|timed out|aborted)\s*(?:[.!:]|$|by)|"
    r"\{\s*\"(?:error|errors|fault|exception)\"\s*:|le (?:serveur|service) (?:ne répond pas|est (?:indisponible|surchargé))|el (?:servidor|servicio) no (?:está|responde)|der (?:server|dienst) (?:antwortet nicht|ist (?:überlastet|nicht))|"
    rf"{THING} (?:could not|cannot|can ?not|can't|couldn't|failed to) be (?:loaded|found|displayed|opened|shown|retrieved|rendered|fetched)|(?:oops|whoops|uh-?oh)\b[!,. ]|something went wrong\b|an (?:unexpected |unknown |internal )?error (?:has )?occurred|"
    r"(?:der|die|das|le|la|les|el|los) \w+ (?:ist|sind|est|sont|está|están) (?:\w+ ){0,2}(?:nicht (?:erreichbar|verfügbar|gefunden)|indisponibles?|introuvables?|no disponibles?|fuera de servicio)|(?:ein (?:\w+ )?fehler ist aufgetreten|une erreur (?:\w+ )?est survenue|se ha producido un error|ha ocurrido un error)|"
    r"服务器(?:繁忙|错误|无响应)|服务(?:暂时)?不可用|(?:页面|系统)?(?:出错了|发生错误)|(?:暂时)?无法(?:打开|显示|加载|访问))",
    regex.I,
)
FAULT = regex.compile(r"(?is)<fault>(?:(?!</fault>).)*+</fault>|<error>\s*<code>(?:(?!</error>).)*+</error>")
#: A record of a failed request in place of a text.
LOGGED = regex.compile(r"(?:status|code|error)\s*=\s*\"?[1-9]\d\d\b\"?[,;\s]+\w+\s*=", regex.I)
#: What the makers of pages and forms ask of a reader: an order at the start of a sentence whose object is a part of
#: the page, the browser or the form.
ORDER = regex.compile(
    r"(?:please |now |then |or |and |first,? |kindly )*(?:(?:enable|activate|allow|reload|refresh|return to|go back to|go to|retry|contact|click(?: on)?|press|tap(?: on)?|upgrade|insert|type|paste|drag|fill in|close|log ?in to|sign ?in to)\b[^.!?\n]{0,80}?\b"
    r"(?:previous page|home ?page|this page|the page|browsers?|java ?scripts?|cookies|website|this site|window|this tab|button|this box|the box|text box|this field|the field below|this form|viewer|settings|your (?:session|connection|network|administrator|provider|account|text|words|content|title|name)|site (?:owner|administrator)|help ?desk)\b|"
    r"(?:wait|try again|come back|check back)\b[^.!?\n]{0,30}?\b(?:reload|refresh|later|seconds?|minutes?|soon)\b(?! (?:of|for|in|than)\b)|too many requests (?:from|by)\b|replace this\b[^.!?\n]{0,40}\b(?:text|words|paragraph|sentence|content)\b)",
    regex.I,
)
#: What stands in place of content where a sentence begins, by kind, in one pattern.
SAID = regex.compile("|".join(f"(?P<{k}>{p.pattern})" for k, p in (("filler", FILLER), ("notice", NOTICE), ("error", ERROR), ("order", ORDER))), regex.I)
#: Words that fill a place; a short sentence of which one makes up a large part says nothing.
EMPTY_WORDS = frozenset("text here words word content note heading paragraph sentence title texte texto".split())
#: A line with one of these reports on messages; it isn't one.
REPORTS = regex.compile(r"\b(?:we (?:therefore|removed|call|kept|followed|dropped)|were (?:retried|dropped|coded|removed)|answered with|modelled|the log line|crawler|of the sample|in the margin|is treated as|participants|coders)\b", regex.I)
TAGS = regex.compile(r"</?[a-zA-Z][a-zA-Z0-9]*(?:\s[^<>\n]*)?/?>")
#: Lines without any of these have no unfilled field: every alternative of PLACEHOLDER begins with an opening delimiter
#: of its grammar, every one of MISSING holds one of the two words.
TRIGGERS = [*BY_OPENER, "undefined", "nan"]


@functools.lru_cache(maxsize=1)
def _automaton():
    import ahocorasick

    found = ahocorasick.Automaton()
    for word in TRIGGERS:
        found.add_word(word, word)
    found.make_automaton()
    return found


def _masked(text: str) -> str:
    """Code blocks blanked out, so that offsets and line ends stay."""
    return CODE.sub(lambda m: regex.sub(r"[^\n]", " ", m[0]), text) if ("```" in text or "~~~" in text or "\n    " in text or "\n\t" in text or "\\begin{" in text) else text


def _sentence(line: str, a: int, b: int) -> str:
    start = max((line.rfind(x, 0, a) + 2 for x in (". ", "! ", "? ") if line.rfind(x, 0, a) >= 0), default=0)
    ends = [e for e in (line.find(x, b) for x in (". ", "! ", "? ")) if e >= 0]
    return line[start : min(ends) + 1 if ends else len(line)]


def _fields(text: str, hits: list[tuple[int, str]]) -> list[tuple[str, int, int]]:
    """kind, start, end of the placeholders of a text, from the left, none within another; rules are tried only where
    their opening delimiters are."""
    found, end = [], 0
    for at, word in hits:
        if at < end:
            continue
        for kind, pattern in BY_OPENER.get(word, ()):
            if m := pattern.match(text, at):
                found.append((kind, at, m.end()))
                end = m.end()
                break
    return found


def _field(line: str, fields: list[tuple[str, int, int]], missing: bool) -> str | None:
    """What unfilled field a line has, if any, of the fields found in it."""
    hidden = None
    for kind, a, b in fields:
        alone = not regex.sub(r"^\W*(?:[\w ]+:)?|[\W_]", "", line[:a] + line[b:])
        if not alone:
            if hidden is None:
                hidden = [s.span() for s in SPANS.finditer(line)]
            if any(x <= a and b <= y and (x, y) != (a, b) for x, y in hidden):
                continue
            rest = PLACEHOLDER.sub(" ", _sentence(line, a, b))
            if SPEAKS.search(rest):
                continue
            if kind == "format" and regex.search(r"[\\=<>^_]|[{}]", rest):
                continue
        if kind == "guillemet" and not alone and regex.search(r"[«»]", rest) is None and regex.search(r"\b(?:le|la|les|des|une?|est|et|que|pour)\b", rest):
            continue
        return kind
    m = MISSING.search(line) if missing else None
    if m and not any(a <= m.start() and m.end() <= b for a, b in (s.span() for s in SPANS.finditer(line))):
        return "missing"
    return None


def _unmarked(lower: str) -> str:
    for mark in ".,;:!?":
        lower = lower.replace(mark, "")
    return lower


def _typed(bare: str) -> bool:
    """Whether a line without marks has five known words: it has no fewer of them than the line as _lorem reads it."""
    return sum(map(TYPED.__contains__, bare.split())) >= 5


def _lorem(line: str) -> bool:
    words = [w.strip(".,;:!?").lower() for w in line.split()]
    return any(known >= 5 and known >= 0.6 * len(words) for known in (sum(w in LOREM for w in words), sum(w in MASH for w in words)))


def _hollow(line: str, words: list[str]) -> bool:
    """Whether a sentence of a line is mostly one of some empty words: three times at least, a quarter of its words."""
    low = line.lower()
    for word in words:
        if low.count(word) < 3:
            continue
        for sentence in regex.split(r"(?<=[.!?])\s+", low):
            said = regex.findall(r"[^\W\d_]+", sentence)
            if said.count(word) >= 3 and 4 * said.count(word) >= len(said):
                return True
    return False


def _repeated(text: str) -> str | None:
    parts = text.split(". ")
    run = 1
    for x, y in zip(parts, parts[1:]):
        run = run + 1 if x == y and len(x) > 8 else 1
        if run >= LEAST_REPEATS:
            return x
    return None


def inspect(text: str | None) -> tuple[str, str] | None:
    """(kind, evidence) of the first residue of a text, in the order of its lines; None if there is none."""
    if text is None:
        return None
    lower = text.lower()
    if len(lower) != len(text):  # a few capitals have longer lower forms; offsets must hold
        lower = "".join(c.lower() if len(c.lower()) == 1 else c for c in text)
    # a word seven times over has equal neighbours between its separators
    spaced = lower.replace(",", " ").replace(".", " ").split()
    stutter = STUTTER.search(lower) if "xxx" in lower or any(map(operator.eq, spaced, spaced[1:])) else None
    repeated = _repeated(text)
    masked = _masked(text)
    hits = sorted((end + 1 - len(word), word) for end, word in _automaton().iter(lower))
    fields = _fields(masked, hits)
    gaps = [at for at, word in hits if word in ("undefined", "nan")]
    if stutter and masked[stutter.start() : stutter.end()].strip():
        return "filler", stutter[0][:80]
    if repeated:
        return "filler", repeated[:80]
    if ("<fault>" in lower or "<error>" in lower) and (m := FAULT.search(masked)):
        return "error", m[0][:80]
    end = -1
    empty = [w for w in EMPTY_WORDS if lower.count(w) >= 3]
    unmarked = regex.split(r"[\r\n]", _unmarked(masked.lower()))
    for number, line in enumerate(regex.split(r"[\r\n]", masked)):
        start, end = end + 1, end + 1 + len(line)
        if not line.strip():
            continue
        inside = [(k, a - start, b - start) for k, a, b in fields if start <= a and b <= end] if fields else []
        missing = bisect.bisect_left(gaps, start) < bisect.bisect_left(gaps, end)
        if (inside or missing) and (field := _field(line, inside, missing)):
            return "placeholder", f"{field}: {line.strip()[:80]}"
        plain = TAGS.sub(lambda m: " " * len(m[0]), line) if "<" in line else line
        if _typed(_unmarked(plain.lower()) if plain is not line else unmarked[number]) and _lorem(plain):
            return "filler", plain.strip()[:80]
        if empty and _hollow(plain, empty):
            return "filler", plain.strip()[:80]
        for at in (0, *(m.end() for m in SENTENCE.finditer(plain))):
            while at < len(plain) and plain[at] not in "{<" and not plain[at].isalnum():
                if plain[at] in "\"“”„`'":
                    at = len(plain)  # quoted: the sentence speaks of it
                at += 1
            m = SAID.match(plain, at) or (LOGGED.match(plain, at) if "=" in plain else None)
            if m and not REPORTS.search(_sentence(plain, at, at)):
                return {"order": "notice", None: "error"}.get(m.lastgroup, m.lastgroup), plain[at : at + 80]
    return None


def find_residue(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, kind, evidence of every row whose text holds residue; kind is one of KINDS, of the first found.

    Null, empty and blank texts hold none; whole texts are read, whatever their length; repeated rows come out
    as often as they went in. No shuffle: one pass over the scan. Extra columns are ignored.
    """
    rows = df.select(F.col(key).alias("_key"), F.col(text).alias("_text")).where(F.col("_text").isNotNull())

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            found = [(k, *r) for k, t in zip(b["_key"], b["_text"]) if (r := inspect(t))]
            yield pd.DataFrame(found, columns=["_key", "kind", "evidence"]).astype({"_key": b["_key"].dtype})

    kind = rows.schema["_key"].dataType.simpleString()
    return rows.mapInPandas(scan, f"_key {kind}, kind string, evidence string").withColumnRenamed("_key", key)
