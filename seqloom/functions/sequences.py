"""Column functions on nucleotide and peptide sequences."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, functions as F

# The public genetic codes, one letter for each codon in the order TTT, TTC, TTA, TTG, TCT, ... GGG.
GENETIC_CODES = {
    1: "FFLLSSSSYY**CC*WLLLLPPPPHHQQRRRRIIIMTTTTNNKKSSRRVVVVAAAADDEEGGGG",
    4: "FFLLSSSSYY**CCWWLLLLPPPPHHQQRRRRIIIMTTTTNNKKSSRRVVVVAAAADDEEGGGG",
    6: "FFLLSSSSYYQQCC*WLLLLPPPPHHQQRRRRIIIMTTTTNNKKSSRRVVVVAAAADDEEGGGG",
    10: "FFLLSSSSYY**CCCWLLLLPPPPHHQQRRRRIIIMTTTTNNKKSSRRVVVVAAAADDEEGGGG",
    11: "FFLLSSSSYY**CC*WLLLLPPPPHHQQRRRRIIIMTTTTNNKKSSRRVVVVAAAADDEEGGGG",
    12: "FFLLSSSSYY**CC*WLLLSPPPPHHQQRRRRIIIMTTTTNNKKSSRRVVVVAAAADDEEGGGG",
    25: "FFLLSSSSYY**CCGWLLLLPPPPHHQQRRRRIIIMTTTTNNKKSSRRVVVVAAAADDEEGGGG",
    26: "FFLLSSSSYY**CC*WLLLAPPPPHHQQRRRRIIIMTTTTNNKKSSRRVVVVAAAADDEEGGGG",
    29: "FFLLSSSSYYYYCC*WLLLLPPPPHHQQRRRRIIIMTTTTNNKKSSRRVVVVAAAADDEEGGGG",
    30: "FFLLSSSSYYEECC*WLLLLPPPPHHQQRRRRIIIMTTTTNNKKSSRRVVVVAAAADDEEGGGG",
}
#: The other public codes, as codons that differ from code 1.
CODE_CHANGES = {
    2: {"AGA": "*", "AGG": "*", "ATA": "M", "TGA": "W"},
    3: {"ATA": "M", "CTT": "T", "CTC": "T", "CTA": "T", "CTG": "T", "TGA": "W"},
    5: {"AGA": "S", "AGG": "S", "ATA": "M", "TGA": "W"},
    9: {"AAA": "N", "AGA": "S", "AGG": "S", "TGA": "W"},
    13: {"AGA": "G", "AGG": "G", "ATA": "M", "TGA": "W"},
    14: {"AAA": "N", "AGA": "S", "AGG": "S", "TAA": "Y", "TGA": "W"},
    15: {"TAG": "Q"},
    16: {"TAG": "L"},
    21: {"AAA": "N", "AGA": "S", "AGG": "S", "ATA": "M", "TGA": "W"},
    22: {"TCA": "*", "TAG": "L"},
    23: {"TTA": "*"},
    24: {"AGA": "S", "AGG": "K", "TGA": "W"},
    27: {"TAA": "Q", "TAG": "Q", "TGA": "W"},
    28: {"TAA": "Q", "TAG": "Q", "TGA": "W"},
    31: {"TAA": "E", "TAG": "E", "TGA": "W"},
    33: {"AGA": "S", "AGG": "K", "TAA": "Y", "TGA": "W"},
}
#: First two letters of codons whose third letter never matters.
FOURFOLD = ("TC", "CT", "CC", "CG", "AC", "GT", "GC", "GG")
#: Codes in which TA is such a pair as well, as the statistics take it.
FOURFOLD_TA = (6, 29)
#: Stop codons that count for each code; other codes count as code 1.
STOPS = {1: ("TGA", "TAA", "TAG"), 4: ("TAA", "TAG"), 10: ("TAA", "TAG"), 25: ("TAA", "TAG"), 6: ("TGA",), 29: ("TGA",), 30: ("TGA",)}
CODONS = [a + b + c for a in "TCAG" for b in "TCAG" for c in "TCAG"]
CODES = (*GENETIC_CODES, *CODE_CHANGES)


def code_table(code: int = 1) -> dict[str, str]:
    """Codon -> amino acid."""
    return dict(zip(CODONS, GENETIC_CODES[1 if code in CODE_CHANGES else code], strict=True)) | CODE_CHANGES.get(code, {})


def count_of(seq: Column, letters: str) -> Column:
    """How many characters of seq are one of the letters."""
    return F.length(seq) - F.length(F.translate(seq, letters, ""))


def gc_percent(seq: Column) -> Column:
    """Share of G and C in either case, in percent; null for an empty sequence."""
    return F.when(F.length(seq) > 0, 100.0 * count_of(seq, "GCgc") / F.length(seq))


def in_frame(seq: Column) -> Column:
    """The sequence without an incomplete last codon."""
    return F.substring(seq, F.lit(1), (F.floor(F.length(seq) / 3) * 3).cast("int"))


def third(seq: Column, place: int) -> Column:
    """The letters at one place (1 to 3) of all complete codons."""
    return F.regexp_replace(in_frame(seq), "(.)(.)(.)", f"${place}")


def fourfold_thirds(seq: Column, code: int = 1) -> Column:
    """The third letters of codons for which every third letter means the same."""
    pairs = (*FOURFOLD, "TA") if code in FOURFOLD_TA else FOURFOLD
    return F.regexp_replace(in_frame(seq), f"(?:{'|'.join(pairs)})(.)|...", "$1")


def gc_by_place(seq: Column, code: int = 1) -> dict[str, Column]:
    """GC percentages: all, first, second and third places, first and second, fourfold third places; null where there are none."""
    sites = fourfold_thirds(seq, code)
    one, two = third(seq, 1), third(seq, 2)
    return {
        "gc": gc_percent(seq),
        "gc1": gc_percent(one),
        "gc2": gc_percent(two),
        "gc3": gc_percent(third(seq, 3)),
        "gc12": gc_percent(F.concat(one, two)),
        "gc3_4fold": gc_percent(sites),
    }


def expected_enc(gc3_4fold: Column) -> Column:
    """Expected effective number of codons at a GC percentage of silent sites."""
    s = gc3_4fold / 100.0
    return 2.0 + s + 29.0 / (s * s + (1.0 - s) * (1.0 - s))


def codons(seq: Column) -> Column:
    """All complete codons in frame, as an array."""
    return F.regexp_extract_all(in_frame(seq), F.lit("(...)"), F.lit(1))


def scanned(seq: Column) -> Column:
    """The codons that the stop scan looks at: all complete ones, but not the last of a sequence of whole codons."""
    n = F.greatest(F.lit(0), F.ceil((F.length(seq) - 3) / 3))
    return F.substring(seq, F.lit(1), (n * 3).cast("int"))


def stops_in(seq: Column, codon: str) -> Column:
    """How often a codon comes up in frame among the scanned ones."""
    return (F.length(F.regexp_replace(scanned(seq), f"({codon})|...", "$1")) / 3).cast("long")


def reverse_complement(seq: Column) -> Column:
    """The other strand, with the ambiguity letters."""
    return F.reverse(F.translate(seq, "ACGTUMRWSYKVHDBNacgtumrwsykvhdbn", "TGCAAKYWSRMBDHVNtgcaakywsrmbdhvn"))


# Places of the letters T, C, A and G in the codes; any other letter counts as beyond all codons.
_PLACES = np.full(256, len(CODONS), np.int64)
_PLACES[[ord(x) for x in "TCAG"]] = range(4)


def codon_numbers(seq: str) -> np.ndarray:
    """The place in CODONS of each complete codon in frame, 64 for one of other letters than the four."""
    places = _PLACES[np.frombuffer(seq.encode("ascii", "replace"), np.uint8)[: len(seq) // 3 * 3]]
    return np.minimum(places[::3] * 16 + places[1::3] * 4 + places[2::3], len(CODONS))


_GC = np.zeros(256, bool)
_GC[[ord(x) for x in "GCgc"]] = True
PLACES = ("gc", "gc1", "gc2", "gc3", "gc12", "gc3_4fold")


def composition(seq: Column, code: int = 1) -> Column:
    """The percentages of gc_by_place() as a struct, of one look at each sequence."""
    fourfold = np.zeros(17, bool)
    fourfold[["TCAG".index(x) * 4 + "TCAG".index(y) for x, y in ((*FOURFOLD, "TA") if code in FOURFOLD_TA else FOURFOLD)]] = True

    def percent(found: np.ndarray) -> float | None:
        return 100.0 * int(found.sum()) / found.size if found.size else None

    def of(seq: str) -> list[float | None]:
        letters = np.frombuffer(seq.encode("ascii", "replace"), np.uint8)
        by_codon = letters[: len(letters) // 3 * 3].reshape(-1, 3)
        gc, places = _GC[by_codon], _PLACES[by_codon[:, :2]]
        sites = fourfold[np.minimum(places[:, 0] * 4 + places[:, 1], 16)]
        return [percent(x) for x in (_GC[letters], gc[:, 0], gc[:, 1], gc[:, 2], gc[:, :2], gc[sites, 2])]

    def run(seqs: pa.Array) -> pa.Array:
        rows = [[None] * len(PLACES) if x is None else of(x) for x in seqs.to_pylist()]
        return pa.StructArray.from_arrays([pa.array([r[i] for r in rows], pa.float64()) for i in range(len(PLACES))], names=list(PLACES))

    return F.arrow_udf(run, ", ".join(f"{x} double" for x in PLACES))(seq)


def peptide(seq: str, acids: np.ndarray, strip_stops: bool = True) -> str:
    """Amino acids of all complete codons; acids: the letter of each codon and X."""
    out = acids[codon_numbers(seq)].tobytes()
    return (out.rstrip(b"*") if strip_stops else out).decode()


def acids_of(code: int) -> np.ndarray:
    table = code_table(code)
    return np.frombuffer(("".join(table[c] for c in CODONS) + "X").encode(), np.uint8)


def translated(seq: Column, code: int = 1, strip_stops: bool = True) -> Column:
    """Amino acids of all complete codons, X for an unknown one; trailing stops are cut off unless asked otherwise."""
    acids = acids_of(code)

    def run(seqs: pa.Array) -> pa.Array:
        return pa.array([None if x is None else peptide(x, acids, strip_stops) for x in seqs.to_pylist()], pa.string())

    return F.arrow_udf(run, "string")(F.upper(seq))


_STRANDS = str.maketrans("ACGTUMRWSYKVHDBNacgtumrwsykvhdbn", "TGCAAKYWSRMBDHVNtgcaakywsrmbdhvn")


def six_translated(seq: Column, code: int = 1) -> Column:
    """An array of what translated() makes of the reading frames 1 to 6; each strand is read once."""
    acids = acids_of(code)

    def frames(seq: str) -> list[str]:
        return [peptide(strand[n:].upper(), acids) for strand in (seq, seq.translate(_STRANDS)[::-1]) for n in range(3)]

    def run(seqs: pa.Array) -> pa.Array:
        return pa.array([None if x is None else frames(x) for x in seqs.to_pylist()], pa.list_(pa.string()))

    return F.arrow_udf(run, "array<string>")(seq)


def frame(seq: Column, number: int) -> Column:
    """The sequence from reading frame 1 to 6 on; 4 to 6 are those of the other strand."""
    strand = seq if number < 4 else reverse_complement(seq)
    return F.substring(strand, F.lit((number - 1) % 3 + 1), F.length(seq))


def kmers(seq: Column, k: int = 5, step: int = 1) -> Column:
    """All k-mers as an array, in order; step k leaves out those that overlap."""
    every = F.regexp_extract_all(seq, F.lit(f"(?=(.{{{k}}}))"), F.lit(1))
    return every if step == 1 else F.filter(every, lambda _, i: i % step == 0)


def is_complete_cds(seq: Column, prokaryote: bool = False) -> Column:
    """Whole codons, a start codon and a stop codon, in either case."""
    s = F.upper(seq)
    starts = ("ATG", "TTG", "GTG") if prokaryote else ("ATG",)
    return (F.length(s) % 3 == 0) & F.right(s, F.lit(3)).isin("TGA", "TAA", "TAG") & F.left(s, F.lit(3)).isin(*starts)


def orf_slice(seq: Column, start: Column, end: Column, frame_number: Column) -> Column:
    """The hit's part of a sequence, on its strand, cut to whole codons at its end."""
    lo, hi = F.least(start, end), F.greatest(start, end)
    part = F.substring(seq, lo, hi - lo + 1)
    part = F.when(frame_number < 0, reverse_complement(part)).otherwise(part)
    return F.substring(part, F.lit(1), (F.length(part) - F.length(part) % 3).cast("int"))


def profile_orf_slice(seq: Column, start_aa: Column, end_aa: Column, frame_number: Column) -> Column:
    """The nucleotides of a profile hit given in amino acids of one of six frames."""
    forward = frame_number < 4
    text = F.when(forward, seq).otherwise(reverse_complement(seq))
    begin = F.greatest(F.lit(0), start_aa * 3 - F.when(forward, 4 - frame_number).otherwise(7 - frame_number))
    end = end_aa * 3 + F.when(forward, frame_number - 1).otherwise(frame_number - 4)
    return F.substring(text, (begin + 1).cast("int"), F.greatest(F.lit(0), end - begin).cast("int"))


def coverage_of(name: Column) -> Column:
    """The number after _Cov_ (in either case) in a name, else null."""
    return F.nullif(F.regexp_extract(name, "_[Cc]ov_([0-9.eE+-]*)", 1), F.lit("")).try_cast("double")
