"""Parameters of all steps: defaults, and what a user overrides."""

from __future__ import annotations

from dataclasses import dataclass, fields, replace


@dataclass(frozen=True)
class Params:
    # merging of mates
    fastq_ascii: int = 33
    fastq_maxee: float = 1
    fastq_maxmergelen: int = 500
    fastq_maxns: int = 0
    fastq_minlen: int = 50
    fastq_minmergelen: int = 100
    fastq_minovlen: int = 50
    fastq_truncqual: int = 10
    # trimming
    cutadapt_error_rate: float = 0.1
    cutadapt_minimum_length: int = 50
    cutadapt_maximum_length: int = 500
    # filters
    global_read_count_cutoff: int = 2
    lfn_variant_cutoff: float | None = 0.001
    lfn_variant_replicate_cutoff: float | None = None
    lfn_sample_replicate_cutoff: float = 0.001
    lfn_read_count_cutoff: int = 10
    min_replicate_number: int = 2
    pcr_error_var_prop: float = 0.1
    uchime3_denovo_abskew: float = 16
    renkonen_distance_quantile: float = 0.9
    skip_filter_indel: bool = False
    skip_filter_codon_stop: bool = False
    genetic_code: int = 5
    # tables and taxa
    cluster_identity: float = 0.97
    ltg_rule_threshold: int = 97
    include_prop: float = 90
    min_number_of_taxa: int = 3
    qcov_hsp_perc: float = 80


def resolve(given: dict | None = None) -> Params:
    """Defaults with the user's values; an unknown name is an error, as are both modes of the variant cutoff at once.

    Giving the variant-replicate cutoff alone switches the mode.
    """
    given = dict(given or {})
    unknown = sorted(set(given) - {f.name for f in fields(Params)})
    if unknown:
        raise ValueError(f"unknown parameters: {', '.join(unknown)}")
    if given.get("lfn_variant_replicate_cutoff") is not None:
        if given.get("lfn_variant_cutoff") is not None:
            raise ValueError("lfn_variant_cutoff and lfn_variant_replicate_cutoff exclude each other")
        given["lfn_variant_cutoff"] = None
    return replace(Params(), **given)


def read_params(path: str) -> Params:
    """Parameters from a text of lines `name: value`, as flat YAML has them; # begins a comment. A value that no parameter takes is an error that names its line."""
    given = {}
    with open(path, encoding="utf-8") as lines:
        for number, line in enumerate(lines, 1):
            name, colon, value = line.split("#")[0].strip().partition(":")
            if not name or name == "---":
                continue
            if not colon:
                raise ValueError(f"{path}, line {number}: not a line of name and value: {line.strip()}")
            try:
                given[name.strip()] = parsed(value.strip())
            except ValueError:
                raise ValueError(f"{path}, line {number}: {name.strip()} can't be {value.strip()}") from None
    return resolve(given)


def parsed(text: str):
    """A number, a truth value or none, in quotes or not; anything else is an error, as no parameter takes it."""
    if len(text) > 1 and text[0] == text[-1] and text[0] in "'\"":
        text = text[1:-1].strip()
    fixed = {"": None, "null": None, "~": None, "true": True, "yes": True, "on": True, "false": False, "no": False, "off": False}
    if text.lower() in fixed:
        return fixed[text.lower()]
    return float(text) if any(c in text for c in ".eE") else int(text)


def chain_options(p: Params) -> dict:
    """The keyword arguments of pairs.filter_chain that the parameters stand for."""
    from varicube.operators.filters import LfnCutoffs

    return {
        "cutoffs": LfnCutoffs(p.lfn_variant_cutoff, p.lfn_variant_replicate_cutoff, p.lfn_sample_replicate_cutoff, p.lfn_read_count_cutoff),
        "least_replicates": p.min_replicate_number,
        "pcr_most": p.pcr_error_var_prop,
        "skew": p.uchime3_denovo_abskew,
        "quantile": p.renkonen_distance_quantile,
        "code": p.genetic_code,
        "skip_indel": p.skip_filter_indel,
        "skip_codon_stop": p.skip_filter_codon_stop,
    }
