"""Harmonization of laboratory results on Spark."""

from assayloom.operators.units import UnitRules
from assayloom.plans.periods import Periods
from assayloom.plans.run import Harmonization, harmonize_folder, write_run
from assayloom.rules import LabColumns, RuleSet, ScopeRules, TextRules
from assayloom.session import prepare
from assayloom.sources.lab import open_lab, read_lab

__all__ = [
    "Harmonization", "LabColumns", "Periods", "RuleSet", "ScopeRules", "TextRules", "UnitRules",
    "harmonize_folder", "open_lab", "prepare", "read_lab", "write_run",
]
