from .scalars import date_key, date_parts, fold_case, parse_event_time, to_money  # noqa: F401
