"""Parameters of a build."""

from __future__ import annotations

from dataclasses import dataclass, field

from pitchlake.operators.watch import Watch

# Competitions whose appearances are kept.
COMPETITION_CODES = (
    "ES1", "GB1", "L1", "IT1", "FR1", "GR1", "PO1", "BE1", "EJPL", "POBE", "BPO4", "UKR1",
    "RU1", "DK1", "SC1", "TR1", "NL1", "NLP", "NLSC", "BESC", "DFB", "POSU", "POCP", "CGB",
    "UKRP", "RUP", "GBCS", "SUC", "DFL", "CDR", "RUSS", "GRP", "SFA", "CIT", "DKP", "FRCH",
    "UKRS", "SCI", "CL", "EL", "KLUB", "ECLQ", "CLQ", "ELQ", "USC", "FAC",
    "FIWC", "EURO", "COPA", "AFCN", "AFAC",
)


@dataclass(frozen=True)
class Settings:
    """``site_root`` goes before every profile link; ``as_of`` stands in for today.

    ``watch`` counts what could not be read while one table is written.
    """
    site_root: str = ""
    as_of: str | None = None
    competition_codes: tuple[str, ...] = field(default=COMPETITION_CODES)
    watch: Watch | None = field(default=None, compare=False, repr=False)
