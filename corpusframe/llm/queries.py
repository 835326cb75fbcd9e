"""Every query of this subpackage; importing it registers them."""

from corpusframe.llm import audit, decontaminate, lattice, lines, merkle, mixing, neighbours, packing, quality, secrets, simhash, substrings, urls  # noqa: F401
from corpusframe.llm.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
