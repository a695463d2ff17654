"""Column functions on texts: slugs, link tokens, uploads, reactions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Domain endings and their tokens (first match wins), reaction prefixes,
# and the patterns of links, media wrappers and upload notes.
DOMAIN_TOKENS = (
    ("youtube.com", "[youtube link]"),
    ("youtu.be", "[youtube link]"),
    ("instagram.com", "[instagram link]"),
    ("tiktok.com", "[tiktok link]"),
    ("spotify.com", "[spotify link]"),
    ("firebasestorage.googleapis.com", "[image]"),
    ("storage.googleapis.com", "[image]"),
)
REACTIONS = ("Loved ", "Liked ", "Disliked ", "Laughed at ", "Emphasized ", "Questioned ")
URL = r"https?://[^\s<>\")\]]+"
MEDIA = r"\[media:\s*(https?://[^\]]+)\]"
UPLOAD = r"(?s)^NOTE:\s*User uploaded (?:an|\d+) image\(?s?\)?\.\s*User Message:\s*(.*?)\s*Image URLs?:\s*.*$"


def slug(text: Column) -> Column:
    """Lower case, blanks and hyphens to single underscores, none at the ends."""
    s = F.lower(F.regexp_replace(text, r"(?U)^\s+|\s+$", ""))
    s = F.regexp_replace(F.regexp_replace(s, r"(?U)[-\s]+", "_"), "_+", "_")
    return F.regexp_replace(s, "^_+|_+$", "")


def display_name(s: Column) -> Column:
    return F.initcap(F.replace(s, F.lit("_"), F.lit(" ")))


def url_token(url: Column, tokens=DOMAIN_TOKENS) -> Column:
    """The token of a link, by the ending of its domain; contact cards by the ending of the path."""
    domain = F.split_part(F.regexp_replace(url, r"^https?://(www\.)?", ""), F.lit("/"), F.lit(1))
    out = F.lit("[link]")
    for ending, token in reversed(tokens):
        value = F.lit(token) if token != "[image]" else F.when(F.lower(url).endswith(".vcf"), F.lit("[contact card]")).otherwise(F.lit(token))
        out = F.when(domain.endswith(ending), value).otherwise(out)
    return out


def replace_urls(text: Column, tokens=DOMAIN_TOKENS) -> Column:
    """Every media wrapper, then every bare link, by its token; the matches are mapped and the gaps between them kept."""

    def mapped(value: Column, pattern: str, group: int) -> Column:
        found = F.regexp_extract_all(value, F.lit(pattern), F.lit(group))
        gaps = F.split(value, pattern, -1)
        named = F.transform(found, lambda u: url_token(u, tokens))
        return F.when(F.size(found) == 0, value).otherwise(
            F.concat(F.array_join(F.zip_with(F.slice(gaps, 1, F.size(found)), named, lambda a, b: F.concat(a, b)), ""), F.element_at(gaps, -1))
        )

    return mapped(mapped(text, MEDIA, 1), URL, 0)


def clean_upload(text: Column) -> Column:
    """An upload note as the user's text with a tag; other texts with their links replaced."""
    said = F.trim(F.regexp_extract(text, UPLOAD, 1))
    count = F.regexp_extract(text, r"uploaded (\d+) image", 1)
    many = F.coalesce(count.try_cast("int") > 1, F.lit(False))
    prefix = F.when(many, F.concat(F.lit("User uploaded "), count, F.lit(" image(s)"))).otherwise(F.lit("User uploaded an image"))
    note = F.when(said != "", F.concat(prefix, F.lit(': "'), said, F.lit('" [image]'))).otherwise(F.concat(prefix, F.lit(" [image]")))
    return F.when(text.rlike(UPLOAD), note).otherwise(replace_urls(text))


def is_reaction(text: Column) -> Column:
    out = F.lit(False)
    for p in REACTIONS:
        out = out | text.startswith(p)
    return out


def is_image_only(text: Column) -> Column:
    """The whole text is one image link, or a media wrapper of an image or contact card."""
    t = F.regexp_replace(text, r"(?U)^\s+|\s+$", "")
    bare = t.rlike(f"^(?:{URL})$") & (url_token(t) == "[image]")
    wrapped = t.rlike(f"^(?:{MEDIA})$") & url_token(F.regexp_extract(t, MEDIA, 1)).isin("[image]", "[contact card]")
    return bare | wrapped
