from stockroom.functions.money import AMOUNT, MONEY, TOTAL, WIDE, as_double, is_price, line_amount, total, unfit, wide

__all__ = ["AMOUNT", "MONEY", "TOTAL", "WIDE", "as_double", "is_price", "line_amount", "total", "unfit", "wide"]
