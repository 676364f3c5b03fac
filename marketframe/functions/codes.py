"""Code maps, as literal map columns, and the lookup that applies them."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# Codes used by the message feed and the names stored in the tables.
OCA_TYPE = {1: "CancelWithBlock", 2: "ReduceWithBlock", 3: "ReduceNonBlock"}
TRIGGER_METHOD = {
    0: "Default",
    1: "DoubleBidAsk",
    2: "Last",
    3: "DoubleLast",
    4: "BidAsk",
    7: "LastOrBidAsk",
    8: "MidPoint",
}
RULE_80A = {
    "": None,
    "0": None,
    "I": "Individual",
    "A": "Agency",
    "W": "AgentOtherMember",
    "J": "IndividualPTIA",
    "U": "AgencyPTIA",
    "M": "AgentOtherMemberPTIA",
    "K": "IndividualPT",
    "Y": "AgencyPT",
    "N": "AgentOtherMemberPT",
}
OPEN_CLOSE = {"": None, "O": "Open", "C": "Close"}
ORIGIN = {0: "Customer", 1: "Firm", 2: "Unknown"}
SHORT_SALE_SLOT = {0: None, 1: "Holding", 2: "Elsewhere"}
VOLATILITY_TYPE = {0: None, 1: "Daily", 2: "Annual"}
REFERENCE_PRICE_TYPE = {0: None, 1: "Average", 2: "BidOrAsk"}
HEDGE_TYPE = {"": None, "D": "Delta", "B": "Beta", "F": "FX", "P": "Pair"}
AUCTION_STRATEGY = {0: "Unset", 1: "Match", 2: "Improvement", 3: "Transparent"}
# In the order of the published list, which runs over two columns.
SPECIAL_CONDITION = {
    "B": "Average Price Trade",
    "Q": "Market Center Official Open",
    "C": "Cash Trade (Same Day Clearing)",
    "R": "Seller",
    "D": "Distribution",
    "T": "Extended Hours Trade",
    "E": "Automatic Execution",
    "U": "Extended Hours Sold (Out of Sequence)",
    "F": "Intermarket Sweep Order",
    "V": "Stock-Option Trade",
    "G": "Bunched Sold Trade",
    "X": "Cross Trade",
    "H": "Price Variation Trade",
    "Z": "Sold (Out of Sequence)",
    "I": "Odd Lot Trade",
    "4": "Derivatively priced",
    "K": "Rule 127 (NYSE only) or Rule 155 (NYSE MKT only)",
    "5": "Market Center Reopening Trade",
    "L": "Sold Last (Late Reporting)",
    "6": "Market Center Closing Trade",
    "M": "Market Center Official Close",
    "7": "Reserved",
    "N": "Next Day Trade (Next Day Clearing)",
    "8": "Reserved",
    "O": "Market Center Opening Trade",
    "9": "Corrected Consolidated Close Price as per Listing Market",
    "P": "Prior Reference Price",
}
NEWS_MESSAGE_TYPE = {1: "NEWS", 2: "EXCHANGE_AVAILABLE", 3: "EXCHANGE_UNAVAILABLE"}
ARTICLE_TYPE = {0: "PlainTextOrHtml", 1: "BinaryDataOrPdf"}
OPTION_TICK_ATTRIB = {0: "Return-based", 1: "Price-based"}
ALLOCATION_TYPE = {"1": "Percentages", "2": "Financial Ratios", "3": "Shares"}

# The order columns that hold a code, with the map that names it.
ORDER_CODES = {
    "OcaType": OCA_TYPE,
    "TriggerMethod": TRIGGER_METHOD,
    "Rule80A": RULE_80A,
    "OpenClose": OPEN_CLOSE,
    "Origin": ORIGIN,
    "ShortSaleSlot": SHORT_SALE_SLOT,
    "AuctionStrategy": AUCTION_STRATEGY,
    "VolatilityType": VOLATILITY_TYPE,
    "ReferencePriceType": REFERENCE_PRICE_TYPE,
    "HedgeType": HEDGE_TYPE,
}


def literal_map(codes: Mapping) -> Column:
    """A string-to-string map literal; keys are compared by their text."""
    pairs = [F.lit(x).cast("string") for key, name in codes.items() for x in (str(key), name)]
    return F.create_map(*pairs)


def map_values(code: Column, codes: Mapping) -> Column:
    """NULL stays NULL, a known code gives its name (which may be NULL), others ``UNKNOWN(code)``."""
    names, text = literal_map(codes), code.cast("string")
    name = F.try_element_at(names, text)
    unknown = F.concat(F.lit("UNKNOWN("), text, F.lit(")"))
    if None not in codes.values():
        return F.coalesce(name, unknown)
    return F.when(F.map_contains_key(names, text), name).otherwise(unknown)


def name_order_codes(df):
    """Replace every order code column present in the frame by its name."""
    present = {c: map_values(F.col(c), codes) for c, codes in ORDER_CODES.items() if c in df.columns}
    return df.withColumns(present) if present else df
