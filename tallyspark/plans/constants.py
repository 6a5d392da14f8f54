"""Chart of accounts, posting templates, currencies, alert rules, budget aliases, holidays.

They are small tables with a bound set by the business (an account plan, a rule list), written as SQL VALUES so that Spark
knows their size and plans hash joins with them on its own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

AS_OF = "2001-12-31"
AS_OF_PERIOD = 200112
CLOSED_BEFORE = 200101
LATE_AFTER_DAYS = 5

# ---- fixed values -----------------------------------------------------------------------------------------------
ACCOUNT_COLUMNS = ["account_code", "account_name", "universal_node", "account_type", "normal_balance", "l1_category",
                   "l2_subcategory", "pl_line_item", "cf_classification", "is_ic_account"]
ACCOUNTS = [
    ("13", "Machinery", "ASSET.NONCURRENT.PPE.MACHINERY", "Asset", "D", "Asset", "Non-current", None, "Investing", False),
    ("19", "Accumulated depreciation", "ASSET.NONCURRENT.ACCUMULATED_DEPRECIATION", "Asset", "C", "Asset", "Non-current", None, None, False),
    ("212", "Finished goods", "ASSET.CURRENT.INVENTORY.FINISHED_GOODS", "Asset", "D", "Asset", "Current", None, "Operating", False),
    ("311", "Trade receivables", "ASSET.CURRENT.RECEIVABLES.TRADE", "Asset", "D", "Asset", "Current", None, "Operating", False),
    ("314", "Intercompany receivables", "ASSET.CURRENT.RECEIVABLES.INTERCOMPANY", "Asset", "D", "Asset", "Current", None, "Operating", True),
    ("382", "Bank accounts", "ASSET.CURRENT.CASH.BANK", "Asset", "D", "Asset", "Current", None, "Operating", False),
    ("419", "Profit of the year", "EQUITY.CURRENT_YEAR_PROFIT", "Equity", "C", "Equity", "Current Year Profit", None, "Financing", False),
    ("432", "Long-term loans", "LIABILITY.NONCURRENT.DEBT.LOANS", "Liability", "C", "Liability", "Non-current", None, "Financing", False),
    ("441", "Short-term loans", "LIABILITY.CURRENT.DEBT.LOANS", "Liability", "C", "Liability", "Current", None, "Financing", False),
    ("454", "Trade payables", "LIABILITY.CURRENT.PAYABLES.TRADE", "Liability", "C", "Liability", "Current", None, "Operating", False),
    ("455", "Intercompany payables", "LIABILITY.CURRENT.PAYABLES.INTERCOMPANY", "Liability", "C", "Liability", "Current", None, "Operating", True),
    ("462", "Payroll payables", "LIABILITY.CURRENT.PAYABLES.PAYROLL", "Liability", "C", "Liability", "Current", None, "Operating", False),
    ("467", "Other short-term payables", "LIABILITY.CURRENT.OTHER", "Liability", "C", "Liability", "Current", None, "Operating", False),
    ("51", "Material costs", "COGS.MATERIALS", "Expense", "D", "COGS", "Materials", "COGS", "Operating", False),
    ("511", "Intercompany purchases", "COGS.PURCHASE_COST", "Expense", "D", "COGS", "Purchase Cost", "COGS", "Operating", True),
    ("56", "Payroll", "OPEX.PERSONNEL", "Expense", "D", "OPEX", "Payroll", "Personnel", "Operating", False),
    ("57", "Depreciation", "OPEX.DEPRECIATION", "Expense", "D", "OPEX", "Depreciation", "DA", "Operating", False),
    ("58", "Other costs", "OPEX.OTHER", "Expense", "D", "OPEX", "Other", "Other OpEx", "Operating", False),
    ("861", "Interest paid", "FINANCIAL.EXPENSE.INTEREST", "Expense", "D", "Financial", "Financial Expense", "Fin_Expense", "Operating", False),
    ("891", "Income tax", "TAX.INCOME_TAX", "Expense", "D", "Tax", "Income Tax", "Tax", "Operating", False),
    ("971", "Net sales", "REVENUE.SALES", "Revenue", "C", "Revenue", "Net Sales", "Revenue", "Operating", False),
    ("9711", "Intercompany sales", "REVENUE.SALES.INTERCOMPANY", "Revenue", "C", "Revenue", "Net Sales", "Revenue", "Operating", True),
    ("974", "Interest earned", "FINANCIAL.INCOME.INTEREST", "Revenue", "C", "Financial", "Financial Income", "Fin_Income", "Operating", False),
]

# Second version of the account plan: 58 moves to COGS, 57 is renamed, 441 is gone, 59 is new.
ACCOUNTS_V2 = [
    (("58", "Other costs", "COGS.OTHER", "Expense", "D", "COGS", "Other", "COGS", "Operating", False) if row[0] == "58"
     else (row[0], "Depreciation and amortisation", *row[2:]) if row[0] == "57" else row)
    for row in ACCOUNTS if row[0] != "441"
] + [("59", "Sundry costs", "OPEX.SUNDRY", "Expense", "D", "OPEX", "Other", "Other OpEx", "Operating", False)]

# leg, who posts, debit/credit account for outside trade, debit/credit account for intercompany trade, amount column
LEG_COLUMNS = ["leg", "poster", "debit", "credit", "debit_ic", "credit_ic", "amount"]
LEGS = [
    ("S1", "seller", "311", "971", "314", "9711", "a_sale"),
    ("S2", "seller", "51", "212", "51", "212", "a_cost"),
    ("S3", "seller", "58", "382", "58", "382", "a_other"),
    ("S3U", "seller", "999", "382", "999", "382", "a_unmapped"),
    ("S4", "seller", "56", "462", "56", "462", "a_payroll"),
    ("S5", "seller", "57", "19", "57", "19", "a_depr"),
    ("S6", "seller", "861", "441", "861", "441", "a_intexp"),
    ("S7", "seller", "382", "974", "382", "974", "a_intinc"),
    ("S8", "seller", "891", "467", "891", "467", "a_tax"),
    ("S9", "seller", "382", "311", "382", "311", "a_receipt"),
    ("S10", "seller", "13", "432", "13", "432", "a_capex"),
    ("S11", "seller", "212", "454", "212", "454", "a_goods"),
    ("B1", "buyer", "511", "455", "511", "455", "a_icbuy"),
]

# intercompany relations: transaction type, elimination type, account of the seller, account of the buyer
IC_TYPES = [("GOODS_SALE", "REVENUE_EXPENSE", "9711", "511"), ("LOAN", "RECEIVABLE_PAYABLE", "314", "455"), ("MANAGEMENT_FEE", "REVENUE_EXPENSE", "9712", "512")]
#: A pair's number leaves room for so many buyers, times ten relations.
PAIR_STEP = 10_000_000_000
IC_ACCOUNTS = sorted({a for t in IC_TYPES for a in t[2:]})

# currency of a nation by its region number, with the base quote in HUF
CURRENCIES = [("HUF", 0, 1), ("USD", 1, 340), ("EUR", 2, 380), ("GBP", 3, 450), ("CHF", 4, 390)]
KNOWN_CURRENCIES = ["HUF", "EUR", "USD", "GBP", "CHF", "CZK", "PLN", "RON", "RSD"]

SOURCE_SYSTEMS = ["COBALT", "SAP_B1", "SZAMLAZZ"]

BUDGET_ALIASES = {"BUDGET": "ORIGINAL_BUDGET", "ORIGINAL_BUDGET": "ORIGINAL_BUDGET", "REVISED": "REVISED_BUDGET",
                  "REVISED_BUDGET": "REVISED_BUDGET", "FORECAST": "ROLLING_FORECAST",
                  "ROLLING_FORECAST": "ROLLING_FORECAST"}

RULE_COLUMNS = ["rule_code", "kpi_name", "entity_scope", "operator", "threshold_value", "threshold_unit", "severity",
                "cooldown_hours"]
ALERT_RULES = [
    ("CASH_CRITICAL", "cash_balance", "ALL", "<", 50000000.0, "ABSOLUTE", "CRITICAL", 4),
    ("EBITDA_MARGIN_LOW", "ebitda_margin_ratio", "ALL", "<", 0.05, "ABSOLUTE", "HIGH", 24),
    ("REVENUE_VS_BUDGET", "revenue_vs_budget_ratio", "ALL", "<", -0.10, "ABSOLUTE", "HIGH", 24),
    ("DSO_EXCESSIVE", "dso_days", "ALL", ">", 75.0, "ABSOLUTE", "MEDIUM", 48),
    ("NET_DEBT_EBITDA", "net_debt_ebitda", "ALL", ">", 3.5, "ABSOLUTE", "HIGH", 48),
    ("OVERDUE_AP", "overdue_ap_pct", "ALL", ">", 0.15, "ABSOLUTE", "MEDIUM", 48),
    ("LARGE_GL_POSTING", "unusual_gl_amount_huf", "ALL", ">", 100000000.0, "ABSOLUTE", "LOW", 1),
    ("NEGATIVE_GROWTH", "revenue_yoy_ratio", "ALL", "<", 0.0, "ABSOLUTE", "MEDIUM", 168),
    ("EBITDA_VS_BUDGET", "ebitda_vs_budget_ratio", "ALL", "<", -0.15, "ABSOLUTE", "HIGH", 24),
    ("CASH_RUNWAY", "cash_runway_days", "ALL", "<", 30.0, "ABSOLUTE", "CRITICAL", 4),
]
# Rules of this build: unit-scaled thresholds, one entity scope that exists and one that does not.
LOCAL_RULES = [
    ("REVENUE_BELOW_BUDGET_SHARE", "revenue", "ALL", "<", 0.9, "PCT_OF_BUDGET", "HIGH", 24),
    ("REVENUE_BELOW_PY_SHARE", "revenue", "NATION_3", "<=", 0.95, "PCT_OF_PY", "MEDIUM", 24),
    ("EBITDA_NEGATIVE", "ebitda", "NOWHERE", "<", 0.0, "ABSOLUTE", "HIGH", 24),
    ("LARGE_SALE_LINE", "sale_line_amount", "ALL", ">", 90000.0, "ABSOLUTE", "LOW", 48),
]


def rule(code: str) -> dict:
    return next(dict(zip(RULE_COLUMNS, r)) for r in ALERT_RULES + LOCAL_RULES if r[0] == code)


SEVERITIES = ["CRITICAL", "HIGH", "MEDIUM", "LOW", "INFO"]

# public holidays with a fixed day: month, day
FIXED_HOLIDAYS = [(1, 1), (3, 15), (5, 1), (8, 20), (10, 23), (11, 1), (12, 25), (12, 26)]
DAYS_AFTER_EASTER = [-2, 1, 50]  # Good Friday, Easter Monday, Whit Monday

BRIDGE_STEPS = [
    (1, "Revenue", "start"), (2, "Other Operating Income", "add"), (3, "COGS", "subtract"), (4, "Gross Profit", "subtotal"),
    (5, "Personnel", "subtract"), (6, "Other OpEx", "subtract"), (7, "EBITDA", "subtotal"), (8, "Depreciation", "subtract"),
    (9, "Financial Items", "add"), (10, "Tax", "subtract"), (11, "Net Profit", "end"),
]
# -----------------------------------------------------------------------------------------------------------------


def literal(value) -> str:
    if value is None:
        return "CAST(NULL AS STRING)"
    if isinstance(value, bool):
        return "true" if value else "false"
    if isinstance(value, float):
        return f"CAST({value!r} AS DOUBLE)"
    if isinstance(value, int):
        return str(value)
    return "'" + str(value).replace("'", "''") + "'"


def values_sql(rows, columns) -> str:
    body = ", ".join("(" + ", ".join(literal(v) for v in row) + ")" for row in rows)
    return f"SELECT * FROM (VALUES {body}) AS v({', '.join(columns)})"


def frame(spark: SparkSession, rows, columns) -> DataFrame:
    return spark.sql(values_sql(rows, columns))
