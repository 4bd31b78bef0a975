"""Packed names: taxon, optional code, sequence id and gene family (OG), parted by a delimiter."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def taxon_of(name: Column, delim: str = "|") -> Column:
    """What stands before the first delimiter."""
    return F.split_part(name, F.lit(delim), F.lit(1))


def og_of(name: Column, delim: str = "|") -> Column:
    """What stands after the last delimiter."""
    return F.substring_index(name, delim, -1)


def without_og(name: Column, delim: str = "|") -> Column:
    """What stands before the last delimiter; empty if there is none."""
    parts = F.split(name, _quoted(delim))
    return F.array_join(F.slice(parts, F.lit(1), F.size(parts) - 1), delim)


def sequence_prefix(name: Column, delim: str = "|") -> Column:
    """The name without its last two fields, by which copies of one taxon's gene are told."""
    parts = F.split(name, _quoted(delim))
    return F.array_join(F.slice(parts, F.lit(1), F.greatest(F.lit(0), F.size(parts) - 2)), delim)


def display_id(taxon: Column, seq_id: Column, code: Column | None = None, delim: str = "|") -> Column:
    """taxon|[code|]id. With a code, every delimiter of the plain name becomes delimiter, code, delimiter."""
    plain = F.concat(taxon, F.lit(delim), seq_id)
    return plain if code is None else F.replace(plain, F.lit(delim), F.concat(F.lit(delim), code, F.lit(delim)))


def with_og(name: Column, og: Column, delim: str = "|", og_delim: str = "|") -> Column:
    """Puts the OG at the end; a delimiter of its own goes before unless it is the same as that of the OG."""
    return F.concat(name, F.lit("" if delim == og_delim else delim), F.lit(og_delim), og)


def tag(header: Column, key: str) -> Column:
    """Value of [key=value] in a header, else null."""
    return F.nullif(F.regexp_extract(header, rf"\[{key}=([^\]]*)\]", 1), F.lit(""))


def locus_of(header: Column) -> Column:
    """The locus tag, else the gene, of headers that name a protein as well as of those that don't."""
    return F.coalesce(tag(header, "locus_tag"), tag(header, "gene"))


def _quoted(delim: str) -> str:
    return "".join("\\" + c if not c.isalnum() else c for c in delim)
