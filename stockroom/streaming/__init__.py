from stockroom import files
from stockroom.streaming.triggers import (CUSTOMER_RULES, ORDER_RULES, InsertRules, InsertTrigger,
                                          accepted_rows, audit_log, kept_totals, on_insert,
                                          register_trigger_views, rejected_rows)

__all__ = ["files", "CUSTOMER_RULES", "ORDER_RULES", "InsertRules", "InsertTrigger",
           "accepted_rows", "audit_log", "kept_totals", "on_insert", "register_trigger_views", "rejected_rows"]
