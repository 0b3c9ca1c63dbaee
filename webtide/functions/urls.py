"""URL expressions. All are plain Columns, none needs Python per row."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from webtide.functions.text import SPACE_CHARS, strip

_WEB = r"\Ahttps?://"
# Letters that match [a-z] when case is ignored: ASCII plus four odd ones.
_LETTER = r"A-Za-z\u0130\u0131\u017f\u212a"
_HOST_PATH = rf"(?:[{_LETTER}0-9-]++\.)+[{_LETTER}]{{2,}}(?:/[^{SPACE_CHARS}]*+)?\z"

# RFC 3986, appendix B
_PARTS = r"(?s)\A(?:([A-Za-z][A-Za-z0-9+.-]*):)?(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?(?:#(.*))?\z"

# Schemes that take a host and relative references / ;parameters.
_RELATIVE = (
    "", "ftp", "http", "gopher", "nntp", "imap", "wais", "file", "https", "shttp", "mms",
    "prospero", "rtsp", "rtsps", "rtspu", "sftp", "svn", "svn+ssh", "ws", "wss",
)
_PARAMS = (
    "", "ftp", "hdl", "prospero", "http", "https", "shttp", "rtsp", "rtsps", "sip", "sips",
    "mms", "sftp", "tel",
)


def clean_url(c: Column) -> Column:
    """Strip blanks, then trailing slashes, then the fragment - in that order."""
    return F.split_part(
        F.regexp_replace(strip(c), r"(?<!/)/++\z", ""), F.lit("#"), F.lit(1)
    )


def with_protocol(c: Column) -> Column:
    s = strip(c)
    return F.when(s.rlike(_WEB), s).otherwise(F.concat(F.lit("https://"), s))


_LOW_CHARS = "".join(map(chr, range(0x21)))


def _tidy(c: Column) -> Column:
    """Leading control characters and blanks go, and so do tabs and line ends anywhere."""
    bare = F.ltrim(c, F.lit(_LOW_CHARS))
    # looking for them is far cheaper than translating every character
    found = reduce(or_, [F.contains(c, F.lit(x)) for x in "\t\r\n"])
    return F.when(found, F.translate(bare, "\t\r\n", "")).otherwise(bare)


def scheme(c: Column) -> Column:
    return F.lower(F.regexp_extract(_tidy(c), _PARTS, 1))


def netloc(c: Column) -> Column:
    return F.regexp_extract(_tidy(c), _PARTS, 2)


def _full_path(c: Column) -> Column:
    return F.regexp_extract(_tidy(c), _PARTS, 3)


def path(c: Column) -> Column:
    """Path without the ;parameters of its last segment."""
    whole = _full_path(c)
    return F.when(scheme(c).isin(*_PARAMS), F.regexp_replace(whole, r";[^/]*\z", "")).otherwise(whole)


def query(c: Column) -> Column:
    return F.regexp_extract(_tidy(c), _PARTS, 4)


def fragment(c: Column) -> Column:
    return F.regexp_extract(_tidy(c), _PARTS, 5)


def normalize_domain(c: Column) -> Column:
    """Lower-case host part without one leading 'www.'; port and user info stay."""
    low = F.lower(strip(c))
    host = F.when(low.rlike(_WEB), netloc(low)).otherwise(low)
    return F.regexp_replace(host, r"\Awww\.", "")


def validate_url(c: Column) -> Column:
    """A web address or bare host name with an alphabetic last label and an optional path."""
    s = strip(c)
    return F.when(s.rlike(_WEB), s.rlike(rf"\Ahttps?://{_HOST_PATH}")).otherwise(
        s.rlike(rf"\A{_HOST_PATH}")
    )


def url_struct(c: Column) -> Column:
    return F.struct(
        scheme(c).alias("scheme"),
        netloc(c).alias("netloc"),
        path(c).alias("path"),
        query(c).alias("query"),
    )


def _let(value: Column, body) -> Column:
    """body(value) with the value worked out once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _glue(host: Column, has_host: Column, whole_path: Column, q: Column, frag: Column) -> Column:
    """'//host/path?query#fragment' with empty parts left out."""
    slash = has_host & (whole_path != "") & ~F.startswith(whole_path, F.lit("/"))
    return F.concat(
        F.when(has_host, F.concat(F.lit("//"), host)).otherwise(F.lit("")),
        F.when(slash, F.lit("/")).otherwise(F.lit("")),
        whole_path,
        F.when(q != "", F.concat(F.lit("?"), q)).otherwise(F.lit("")),
        F.when(frag != "", F.concat(F.lit("#"), frag)).otherwise(F.lit("")),
    )


def _without_dots(segments: Column) -> Column:
    """Fold '.' and '..' out of path segments; never empty."""
    step = lambda acc, seg: (
        F.when(seg == "..", F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0))))
        .when(seg == ".", acc)
        .otherwise(F.concat(acc, F.array(seg)))
    )

    def folded(segs: Column) -> Column:
        open_end = F.when(
            F.element_at(segs, -1).isin(".", ".."), F.array(F.lit(""))
        ).otherwise(F.array().cast("array<string>"))
        kept = F.aggregate(segs, F.array().cast("array<string>"), step)
        return F.array_join(F.concat(kept, open_end), "/")

    return _let(
        _let(segments, folded), lambda p: F.when(p == "", F.lit("/")).otherwise(p)
    )


PART_NAMES = ("scheme", "host", "path", "query", "fragment")


def pieces(c: Column) -> Column:
    """The five raw parts as an array, from one match: tidy text has no line end, so these can stand between parts."""
    marked = F.regexp_replace(_tidy(c), _PARTS, "\n".join(f"${k + 1}" for k in range(len(PART_NAMES))))
    return F.split(marked, "\n", -1)


def named(cut: Column) -> dict[str, Column]:
    """The five parts out of `pieces`; `path` still has its ;parameters, and scheme is lower-case."""
    found = {n: F.get(cut, F.lit(k)) for k, n in enumerate(PART_NAMES)}
    return {**found, "scheme": F.lower(found["scheme"])}


def resolve_parts(page: Column, b: dict[str, Column], href: Column, h: dict[str, Column]) -> Column:
    """Address of a link from its own parts `h` and those of its page `b`.

    Web addresses stay as they are, others are resolved against the page.
    """
    own_scheme = F.when(h["scheme"] == "", b["scheme"]).otherwise(h["scheme"])
    base_path = F.regexp_replace(b["path"], r";[^/]*\z", "")
    base = F.split(F.regexp_replace(base_path, r"[^/]*\z", ""), "/")
    # the last piece of `base` is always empty: drop it, but keep the root of an empty base path
    parents = F.when(F.size(base) > 1, F.slice(base, 1, F.size(base) - 1)).otherwise(base)
    below = F.split(h["path"], "/")
    # empty inner segments vanish on relative references only
    dense = F.concat(
        F.slice(parents, 1, 1),
        F.filter(F.slice(parents, 2, F.size(parents)), lambda s: s != ""),
        F.filter(F.slice(below, 1, F.size(below) - 1), lambda s: s != ""),
        F.slice(below, -1, 1),
    )
    rooted = F.startswith(h["path"], F.lit("/"))
    plain = rooted & ~F.contains(h["path"], F.lit("/."))
    segments = F.when(rooted, below).otherwise(dense)
    path = F.when(plain, h["path"]).otherwise(_without_dots(segments))

    same_page = h["path"] == ""
    has_host = h["host"] != ""
    final_path = F.when(has_host, h["path"]).when(same_page, b["path"]).otherwise(path)
    rest = _let(
        final_path,
        lambda p: _glue(
            F.when(has_host, h["host"]).otherwise(b["host"]),
            has_host | (b["host"] != ""),
            p,
            F.when(~has_host & same_page & (h["query"] == ""), b["query"]).otherwise(h["query"]),
            h["fragment"],
        ),
    )
    foreign = (h["scheme"] != "") & (
        (h["scheme"] != b["scheme"]) | ~h["scheme"].isin(*_RELATIVE)
    )
    return (
        F.when(href.rlike(_WEB), href)
        .when(href == "", page)
        .when(foreign, href)
        .otherwise(F.concat(own_scheme, F.lit(":"), rest))
    )


def resolve(page: Column, href: Column) -> Column:
    """Address of a link on a page, from two plain columns; parts are worked out once per row."""
    both = F.struct(pieces(page).alias("b"), pieces(href).alias("h"))
    return _let(both, lambda s: resolve_parts(page, named(s.b), href, named(s.h)))


def extension_list(c: Column) -> Column:
    """'.jpg, png' -> ['.jpg', '.png']; case is kept."""
    items = F.filter(F.transform(F.split(c, ","), strip), lambda x: x != "")
    return F.transform(
        items,
        lambda x: F.when(F.startswith(x, F.lit(".")), x).otherwise(F.concat(F.lit("."), x)),
    )


def decode_percent(c: Column) -> Column:
    """Percent-decoding where '+' stays; text that does not decode stays as it is."""
    plus_safe = F.replace(c, F.lit("+"), F.lit("%2B"))
    return F.when(F.contains(c, F.lit("%")), F.coalesce(F.try_url_decode(plus_safe), c)).otherwise(c)


def robots_path(c: Column) -> Column:
    """What robots rules are compared with: decoded path, parameters, query and fragment; '/' if empty."""
    return _let(pieces(decode_percent(c)), robots_path_of)


def robots_path_of(cut: Column) -> Column:
    """`robots_path` out of the `pieces` of a decoded address."""
    d = named(cut)
    text = _glue(F.lit(""), F.lit(False), d["path"], d["query"], d["fragment"])
    return F.when(text == "", F.lit("/")).otherwise(text)
