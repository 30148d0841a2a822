"""Output texts of the jobs."""

# Texts the reference's jobs print, reproduced as printed. The
# login texts name the window in seconds ({secs}); the other placeholders are
# the limit, the click count and the timeout instant in epoch ms.
LOGIN_BURST = "login fail in {secs}s for {n} times. "
LOGIN_CONSECUTIVE = "login fail 2 times in {secs}s"
LOGIN_PATTERN = "login fail"
CLICK_LIMIT = "Click ad over {limit} times today."
PAID = "payed successfully"
PAID_LATE = "payed but already timeout"
PAY_WITHOUT_CREATE = "payed but not found create log"
ORDER_TIMEOUT = "order timeout"
PATTERN_TIMEOUT = "timeout : +{ms}"
REPORT_HEADER = "窗口结束时间："
ITEM_LABEL = "商品ID = "
PAGE_LABEL = "页面URL = "
COUNT_LABEL = "热门度 = "
RULE = "===================================="
