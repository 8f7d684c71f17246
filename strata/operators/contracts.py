"""Expected layout of a raw text dataset, and the flags that compare a frame with it."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.functions.text import is_present

SCHEMA_FLAG = "_expected_schema_valid"
KEY_FLAG = "_non_null_key_valid"


@dataclass(frozen=True)
class Contract:
    """Ordered column names and the key among them."""

    columns: tuple[str, ...]
    keys: tuple[str, ...]

    @classmethod
    def of(cls, columns: str, keys: str) -> Contract:
        return cls(tuple(columns.split()), tuple(keys.split()))


def flag_contract(df: DataFrame, contract: Contract | None) -> DataFrame:
    """Add the layout flag (same for all rows) and the key flag (per row).

    Nothing is rejected: a frame without a contract, or with a key column missing,
    is passed on with its flags false.
    """
    if contract is None:
        same_layout, keys_usable = False, F.lit(False)
    else:
        same_layout = tuple(df.columns) == contract.columns
        keys_usable = _keys_present(df, contract)
    return df.withColumns({SCHEMA_FLAG: F.lit(same_layout), KEY_FLAG: keys_usable})


def _keys_present(df: DataFrame, contract: Contract) -> Column:
    if not set(contract.keys) <= set(df.columns):
        return F.lit(False)
    return reduce(Column.__and__, [is_present(F.col(key)) for key in contract.keys])
