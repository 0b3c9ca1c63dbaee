"""Whitespace, hashing and HTML text as Column expressions."""

from __future__ import annotations

from html.entities import name2codepoint

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters Unicode calls white space (as a Java regex class, and as plain text).
SPACE_CHARS = (
    r"\t-\r\x1c-\x20\x85\u00a0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
)
SPACE_TEXT = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x20\x85\u00a0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
# The first part of the intersection rejects letters and digits after three comparisons.
SPACE = rf"[[\t-\r\x1c-\x20\x85-\u3000]&&[{SPACE_CHARS}]]"
_ODD_SPACE = rf"[[\t-\r\x1c-\x1f\x85-\u3000]&&[{SPACE_CHARS}]]"

# Runs of white space that are not one plain blank already.
_TO_COLLAPSE = rf"\x20{SPACE}++|{_ODD_SPACE}{SPACE}*+"

# One '<' in front of all of them: other characters are passed over after one comparison.
_OPAQUE = (
    r"!--.*?(?:-->|\z)"
    r"|script(?=[\s/>]).*?(?:</script[^>]*>|\z)"
    r"|style(?=[\s/>]).*?(?:</style[^>]*>|\z)"
)
_OPAQUE_BLOCK = rf"(?is)<(?:{_OPAQUE})"
_TAG = r"""<[/!?a-zA-Z](?:"[^"]*+"|'[^']*+'|[^'">])*+>"""

# Names that this project reads in its own way, or that HTML 4 did not have.
_NAMED_ENTITY = (("nbsp", " "), ("apos", "'"))


def strip(c: Column) -> Column:
    """Drop Unicode white space at both ends."""
    return F.btrim(c, F.lit(SPACE_TEXT))


def content_hash(c: Column) -> Column:
    """SHA-256 of the UTF-8 text, in hex."""
    return F.sha2(c, 256)


# What the standard library knows: HTML's named characters, and the characters that the numbers 128 to 159 mean.
_NAMES = {n: chr(c) for n, c in name2codepoint.items()} | dict(_NAMED_ENTITY)
_WINDOWS = {c: bytes([c]).decode("cp1252", "ignore") or chr(c) for c in range(0x80, 0xA0)}


def _lookup(table: dict, key: Column) -> Column:
    return F.try_element_at(F.create_map(*[F.lit(x) for pair in table.items() for x in pair]), key)


def _code_point(digits: Column, base: int) -> Column:
    """UTF-8 character of a code point; characters no text can hold become U+FFFD."""
    short = F.regexp_replace(digits, r"\A0+", "")
    code = F.coalesce(F.conv(F.substring(short, 1, 8), base, 10).cast("bigint"), F.lit(0))
    b = lambda x: F.lpad(F.hex(x), 2, "0")
    tail = lambda shift: b(F.shiftright(code, shift).bitwiseAND(F.lit(63)) + 128)
    utf8 = (
        F.when(code < 0x80, b(code))
        .when(code < 0x800, F.concat(b(F.shiftright(code, 6) + 192), tail(0)))
        .when(code < 0x10000, F.concat(b(F.shiftright(code, 12) + 224), tail(6), tail(0)))
        .otherwise(F.concat(b(F.shiftright(code, 18) + 240), tail(12), tail(6), tail(0)))
    )
    bad = (
        (F.length(short) > 8)
        | (code <= 0)
        | (code > 0x10FFFF)
        | code.between(0xD800, 0xDFFF)
    )
    plain = F.decode(F.unhex(utf8), "UTF-8")
    windows = _lookup(_WINDOWS, code.cast("int"))
    return F.when(bad, F.lit("\ufffd")).when(code.between(0x80, 0x9F), windows).otherwise(plain)


def _references(c: Column) -> Column:
    """Replace character references by cutting at every '&': each later piece starts with its own name or number.

    One pass, so what a reference stands for is never read as part of another one.
    """
    pieces = F.split(c, "&")

    def decode(piece: Column, ix: Column) -> Column:
        hexa = F.regexp_extract(piece, r"\A#[xX]([0-9a-fA-F]+);", 1)
        deci = F.regexp_extract(piece, r"\A#([0-9]+);", 1)
        named = _lookup(_NAMES, F.regexp_extract(piece, r"\A([a-zA-Z][a-zA-Z0-9]*);", 1))
        rest = F.substr(piece, F.locate(";", piece) + 1)
        return (
            F.when(ix == 0, piece)
            .when(hexa != "", F.concat(_code_point(hexa, 16), rest))
            .when(deci != "", F.concat(_code_point(deci, 10), rest))
            .when(named.isNotNull(), F.concat(named, rest))
            .otherwise(F.concat(F.lit("&"), piece))
        )

    return F.array_join(F.transform(pieces, decode), "")


def unescape(c: Column) -> Column:
    """HTML's named and numeric character references that end with ';'; &nbsp; is a plain blank."""
    decoded = lambda t: F.when(F.contains(t, F.lit("&")), _references(t)).otherwise(t)
    return F.get(F.transform(F.array(c), decoded), F.lit(0))


def drop_opaque(html: Column) -> Column:
    """Remove comments, scripts and style sheets: nothing inside them is an element."""
    return F.regexp_replace(html, _OPAQUE_BLOCK, " ")


def html_to_text(html: Column) -> Column:
    """Visible text of a page: one blank per tag, entities decoded, blanks collapsed."""
    bare = F.regexp_replace(drop_opaque(html), _TAG, " ")
    return strip(F.regexp_replace(unescape(bare), _TO_COLLAPSE, " "))


# Types and address endings that say how a body is read; all else is HTML.
_KINDS = {
    "paged": (("application/pdf",), (".pdf",)),
    "plain": (("text/plain", "text/markdown"), (".txt", ".md")),
    "html": (("text/html", "application/xhtml+xml"), ()),
}


def page_kind(content_type: Column, url: Column) -> Column:
    """html, plain or paged: a type that says so decides, else the address; never NULL."""
    name = F.lower(strip(F.split_part(content_type, F.lit(";"), F.lit(1))))
    kind = F.when(F.lit(False), "")
    for k, (types, _) in _KINDS.items():
        kind = kind.when(name.isin(*types), k)
    for k, (_, endings) in _KINDS.items():
        for e in endings:
            kind = kind.when(F.endswith(F.lower(url), F.lit(e)), k)
    return kind.otherwise("html")


# Every character of a page falls into exactly one of these tokens, so token lengths give positions.
_TOKEN = (
    rf"(?is)[^<]++|<(?:{_OPAQUE}"
    r"""|div(?=[\s/>])(?:"[^"]*+"|'[^']*+'|[^'">])*+>"""
    r"|/div[^>]*>)?"
)
# Attributes before `style` are skipped as wholes: a value that speaks of style is none.
_STYLE = (
    r"""(?is)\A<div(?:[\s/]*+(?!style[\s=/>])[^\s"'>/=]++(?:\s*+=\s*+(?:"[^"]*+"|'[^']*+'|[^\s"'>]++))?+)*+"""
    r"""[\s/]*+style\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)"""
)


def _is_hidden_div(token: Column) -> Column:
    style = F.lower(F.regexp_extract(token, _STYLE, 1))
    squeezed = F.translate(style, " ;", "")
    return F.contains(squeezed, F.lit("display:none"))


def strip_hidden(html: Column) -> Column:
    """Cut every outermost <div> whose style says display:none, with all it holds.

    One pass over the page's tokens with a fixed-size state; only the cut points are collected.
    """
    tokens = F.regexp_extract_all(html, F.lit(_TOKEN), F.lit(0))
    start = F.struct(
        F.lit(0).alias("pos"),
        F.lit(0).alias("depth"),
        F.lit(0).alias("hidden_at"),
        F.lit(0).alias("cut_from"),
        F.array().cast("array<struct<lo:int,hi:int>>").alias("cuts"),
    )

    def step(s: Column, tok: Column) -> Column:
        low = F.lower(F.substring(tok, 1, 5))
        opens = low.isin("<div", "<div>", "<div/") | low.rlike(r"\A<div\s\z")
        closes = low == "</div"
        end = s.pos + F.length(tok)
        begins = opens & (s.hidden_at == 0) & _is_hidden_div(tok)
        ends = closes & (s.hidden_at > 0) & (s.depth == s.hidden_at)
        depth = (
            F.when(opens, s.depth + 1)
            .when(closes, F.greatest(s.depth - 1, F.lit(0)))
            .otherwise(s.depth)
        )
        cut = F.array(F.struct(s.cut_from.alias("lo"), end.alias("hi")))
        return F.struct(
            end.alias("pos"),
            depth.alias("depth"),
            F.when(begins, s.depth + 1).when(ends, F.lit(0)).otherwise(s.hidden_at).alias("hidden_at"),
            F.when(begins, s.pos).otherwise(s.cut_from).alias("cut_from"),
            F.when(ends, F.concat(s.cuts, cut)).otherwise(s.cuts).alias("cuts"),
        )

    def finish(s: Column) -> Column:
        open_cut = F.array(F.struct(s.cut_from.alias("lo"), s.pos.alias("hi")))
        return F.when(s.hidden_at > 0, F.concat(s.cuts, open_cut)).otherwise(s.cuts)

    cuts = F.aggregate(tokens, start, step, finish)
    kept = F.transform(
        F.array(cuts),
        lambda cs: F.array_join(
            F.transform(
                F.sequence(F.lit(0), F.size(cs)),
                lambda k: F.substr(
                    html,
                    F.coalesce(F.get(cs, k - 1).hi, F.lit(0)) + 1,
                    F.coalesce(F.get(cs, k).lo, F.length(html))
                    - F.coalesce(F.get(cs, k - 1).hi, F.lit(0)),
                ),
            ),
            "",
        ),
    )[0]
    may_hide = F.lower(html).rlike(r"display[ ;]*:[ ;]*n|d[ ;]*i[ ;]*s[ ;]*p[ ;]*l[ ;]*a[ ;]*y[ ;]*:")
    return F.when(may_hide, kept).otherwise(html)


_GROUP = 16


def chunks(text: Column, size: int, overlap: int) -> Column:
    """Fixed windows of `size` code points, each starting `size - overlap` after the last one.

    A window is emitted while it is the first or reaches past the overlap of the one before. Where every character
    is one byte, positions are known; else windows are cut out of groups of 16, so that finding a position never
    means walking the whole text again.
    """
    if size < 1 or not 0 <= overlap < size:
        raise ValueError("need 0 <= overlap < size")
    return F.transform(F.array(F.length(text)), lambda length: _windows(text, length, size, size - overlap, overlap))[0]


def _windows(text: Column, length: Column, size: int, step: int, overlap: int) -> Column:
    n = F.when(length <= 0, 0).otherwise(
        F.greatest(F.lit(1), F.ceil((length - overlap) / F.lit(step))).cast("int")
    )
    groups = F.ceil(n / F.lit(_GROUP)).cast("int")

    def group(g: Column) -> Column:
        block = F.substr(text, g * (_GROUP * step) + 1, F.lit(_GROUP * step + overlap))
        width = F.least(F.lit(_GROUP), n - g * _GROUP)
        return F.transform(
            F.array(block),
            lambda b: F.transform(
                F.sequence(F.lit(0), width - 1),
                lambda k: F.substr(b, k * step + 1, F.lit(size)),
            ),
        )[0]

    many = F.flatten(F.transform(F.sequence(F.lit(0), groups - 1), group))
    plain = F.transform(
        F.array(text.cast("binary")),
        lambda b: F.transform(
            F.sequence(F.lit(0), n - 1),
            lambda k: F.substr(b, k * step + 1, F.lit(size)).cast("string"),
        ),
    )[0]
    return (
        F.when(n == 0, F.array().cast("array<string>"))
        .when(F.octet_length(text) == length, plain)
        .otherwise(many)
    )


def paged_chunks(text: Column, size: int, overlap: int) -> Column:
    """Windows of each page on its own; a form feed ends a page."""
    return F.flatten(F.transform(F.split(text, "\f"), lambda page: chunks(page, size, overlap)))


# Two glyph placeholders of a PDF reader in a row.
_CID_RUN = rf"\(cid:\p{{Nd}}++\){SPACE}*+\(cid:\p{{Nd}}++\)"
# One character only; gives up at the first other one.
_REPEATED = rf"(?s)\A{SPACE}*+([^{SPACE_CHARS}])\1*+{SPACE}*+\z"


def is_good_chunk(chunk: Column, source: Column, min_length: int) -> Column:
    """Long enough and, for PDF sources, neither one repeated character nor a run of glyph codes."""
    repeated = F.replace(chunk, F.lit(" "), F.lit("")).rlike(_REPEATED)
    glyphs = F.contains(chunk, F.lit("(cid:")) & chunk.rlike(_CID_RUN)
    pdf_junk = F.endswith(F.lower(source), F.lit(".pdf")) & (repeated | glyphs)
    return (F.length(chunk) >= min_length) & ~F.coalesce(pdf_junk, F.lit(False))


def is_empty_content(html: Column) -> Column:
    """Pages that say 200 but carry no content: too short, access denied, or a small captcha page."""
    low = F.lower(html)
    blank = html.isNull() | (F.length(strip(html)) < 100)
    denied = F.contains(low, F.lit("<title>access denied</title>"))
    captcha = F.contains(low, F.lit("captcha")) & (F.length(html) < 3000)
    return F.coalesce(blank | denied | captcha, F.lit(True))
