"""Column roles of the transaction table and schema-driven role inference."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql.types import NumericType, StringType

BATCH = "batch_index"
ROW = "row_idx"


@dataclass(frozen=True)
class Columns:
    """Names the operators rely on; any table can be used by changing them.

    Fixed values (must equal the reference's for equal results): the column
    names of the bank-transaction table.
    """

    time: str = "Transaction_Date"
    id: str = "Transaction_ID"
    target: str = "Is_Fraud"
    amount: str = "Transaction_Amount"
    balance: str = "Account_Balance"
    age: str = "Age"
    txn_type: str = "Transaction_Type"
    device: str = "Device_Type"
    state: str = "State"
    # Modelling feature lists, in this order.
    numeric_features: tuple[str, ...] = ("Transaction_Amount", "Account_Balance", "Age")
    categorical_features: tuple[str, ...] = (
        "Transaction_Type", "Merchant_Category", "Device_Type", "Account_Type", "State", "Gender",
    )
    # Identifier columns dropped before modelling.
    model_drop: tuple[str, ...] = (
        "Customer_ID", "Customer_Name", "Transaction_ID", "Customer_Email", "Customer_Contact",
        "Merchant_ID", "Transaction_Location", "Transaction_Time", "Transaction_Currency",
        "Transaction_Description", "Bank_Branch", "City",
    )
    # Categorical columns that become basket items.
    basket_columns: tuple[str, ...] = (
        "Transaction_Type", "Merchant_Category", "Device_Type", "Account_Type", "State", "Gender",
    )
    # Columns of the target-rate breakdown.
    rate_columns: tuple[str, ...] = ("Transaction_Type", "Merchant_Category", "Device_Type", "Account_Type")
    batch: str = BATCH
    row: str = ROW
    internal: tuple[str, ...] = field(default=(BATCH, ROW))


DEFAULT_COLUMNS = Columns()


def data_columns(df: DataFrame, cols: Columns = DEFAULT_COLUMNS) -> list[str]:
    """All columns of the table except the batch bookkeeping ones."""
    return [c for c in df.columns if c not in (cols.batch, cols.row)]


def numeric_columns(df: DataFrame, cols: Columns = DEFAULT_COLUMNS) -> list[str]:
    """Numeric columns (the pandas ``np.number`` selection), in table order."""
    skip = {cols.batch, cols.row}
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NumericType) and f.name not in skip]


def categorical_columns(df: DataFrame, cols: Columns = DEFAULT_COLUMNS) -> list[str]:
    """String columns (the pandas object/category selection), in table order."""
    skip = {cols.batch, cols.row}
    return [f.name for f in df.schema.fields if isinstance(f.dataType, StringType) and f.name not in skip]
