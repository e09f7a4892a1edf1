"""Data contracts: declared columns, types, required fields, keys and defaults."""

from pollstone.contracts.model import Contract, ContractField

__all__ = ["Contract", "ContractField"]
