"""The analyses: functions ``(shop, params) -> DataFrame``."""
