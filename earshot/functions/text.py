"""Text, URL and hash expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Results must agree byte for byte with tables written before.
SURROGATE_NULL = "_dbt_utils_surrogate_key_null_"
UUID_NAMESPACE_DNS = "6ba7b8109dad11d180b400c04fd430c8"
URL_SCHEMES = ("android-app://", "http://", "https://")


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def concat(*parts: Column | str) -> Column:
    return F.concat(*map(_col, parts))


def position(needle: str, hay: Column | str) -> Column:
    """1-based place of ``needle``; 0 when absent."""
    return F.instr(_col(hay), needle)


def right(text: Column | str, n: Column | int) -> Column:
    """Last ``n`` characters; empty for n = 0."""
    return F.right(_col(text), F.lit(n) if isinstance(n, int) else n)


def split_part(text: Column | str, delimiter: str, n: int) -> Column:
    """Piece ``n`` (negative counts from the end); empty text past either end."""
    return F.split_part(_col(text), F.lit(delimiter), F.lit(n))


def slugify(text: Column | str) -> Column:
    """Lower-case identifier: blanks and dashes to ``_``, the rest dropped, no leading digit."""
    # What is joined, what is dropped, what may not lead.
    slug = F.lower(_col(text))
    for found, put in (("[ -]+", "_"), ("[^a-z0-9_]+", ""), ("^([0-9])", "_$1")):
        slug = F.regexp_replace(slug, found, put)
    return slug


def slugify_name(text: str) -> str:
    """The same rule for a column name known while the plan is written."""
    words = "_".join(w for w in text.lower().replace("-", " ").split(" ") if w)
    lead = "_" if text[:1] in (" ", "-") else ""
    tail = "_" if text[-1:] in (" ", "-") and words else ""
    slug = "".join(ch for ch in lead + words + tail if ch == "_" or (ch.isascii() and ch.isalnum()))
    return "_" + slug if slug[:1].isdigit() else slug


def get_url_host(url: Column | str) -> Column:
    """What stands before the first slash or question mark, after any schemes in front."""
    return F.regexp_extract(_col(url), f"^(?:{'|'.join(URL_SCHEMES)})*([^/?]*)", 1)


def get_url_path(url: Column | str) -> Column:
    """What follows the first slash up to the query; empty where only a query follows, all of it where nothing does."""
    bare = F.regexp_replace(_col(url), "https?://", "")
    after_host = r"^(?:[^/]*/([^?]*)|[^?]*\?|(.*)$)"
    return F.concat(*[F.regexp_extract(bare, after_host, group) for group in (1, 2)])


def get_url_parameter(url: Column | str, parameter: str) -> Column:
    """Value of ``parameter=`` in the URL, null when absent or empty."""
    return F.nullif(split_part(split_part(url, f"{parameter}=", 2), "&", 1), F.lit(""))


def hash_md5(value: Column | str) -> Column:
    return F.md5(_col(value).cast("string"))


def generate_surrogate_key(fields: Sequence[Column | str], nulls_as_empty: bool = False) -> Column:
    """md5 over the fields as text, joined by ``-``; nulls get a marker of their own."""
    marker = F.lit("" if nulls_as_empty else SURROGATE_NULL)
    return F.md5(F.concat_ws("-", *[F.coalesce(_col(f).cast("string"), marker) for f in fields]))


def snapshot_hash(fields: Sequence[Column | str]) -> Column:
    """md5 over the fields as text, joined by ``|``; nulls count as empty."""
    return F.md5(F.concat_ws("|", *[F.coalesce(_col(f).cast("string"), F.lit("")) for f in fields]))


def track_id_hash(track: Column | str, artist: Column | str) -> Column:
    """Stable track id made from track and artist names."""
    digest = F.md5(F.lower(F.concat(_col(track), F.lit("_"), _col(artist))))
    return F.concat(F.lit("track_"), F.substring(digest, 1, 12))


def uuid5(name: Column | str, namespace_hex: str = UUID_NAMESPACE_DNS) -> Column:
    """Name-based (version 5) UUID, built from SHA-1 inside the JVM."""
    digest = F.sha1(F.concat(F.unhex(F.lit(namespace_hex)), F.encode(_col(name), "UTF-8")))
    nibble = F.conv(F.substring(digest, 17, 1), 16, 10).cast("int")
    return F.concat_ws(
        "-",
        F.substring(digest, 1, 8),
        F.substring(digest, 9, 4),
        F.concat(F.lit("5"), F.substring(digest, 14, 3)),
        F.concat(F.substr(F.lit("89ab"), nibble % 4 + 1, F.lit(1)), F.substring(digest, 18, 3)),
        F.substring(digest, 21, 12),
    )


def event_id_uuid5(user: Column | str, track: Column | str, played_at: Column | str) -> Column:
    """The id of a play: the same play always gets the same id."""
    return uuid5(F.concat_ws("_", _col(user), _col(track), _col(played_at)))


def reasoning_text(cooccurrence: Column | str, affinity: Column | str, sessions: Column | str) -> Column:
    """Sentence that explains a recommendation from its score bands."""
    # The bands and the wording shown to listeners.
    co, aff = _col(cooccurrence), _col(affinity)
    often = F.when(co >= 0.8, "Frequently").when(co >= 0.5, "Often").otherwise("Sometimes")
    together = F.format_string("%s played together (%d sessions)", often, _col(sessions).cast("long"))
    liking = F.when(aff >= 80, "artist is highly preferred").when(aff >= 50, "artist is well-liked")
    return F.concat_ws(", ", together, liking)
