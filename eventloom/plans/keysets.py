"""Key lists and names of the click features.

Fixed values: trained models and submission scripts refer to the columns by these names, and the results must equal
theirs for the same keys. The feature sets of :mod:`eventloom.plans.pipelines` and the single queries both read them.
"""

# Group sizes named after their keys.
SIZES = (
    ("ip", "day", "hour"),
    ("ip", "app"),
    ("ip", "app", "os"),
    ("ip", "app", "channel"),
    ("ip", "device", "os", "app"),
    ("ip", "device", "hour"),
    ("ip", "day", "in_test_hh"),
    ("ip", "channel"),
)

# Group sizes with names of their own.
USER_SIZES = {
    "UsrappCount": ("ip", "app", "device", "os"),
    "UsrCount": ("ip", "os", "device"),
    "nipApp": ("ip", "day", "hour", "app"),
    "nipAppOs": ("ip", "day", "hour", "app", "os"),
    "napp": ("app", "day", "hour"),
    "nappDev": ("app", "day", "device"),
    "nappDevOs": ("app", "day", "device", "os"),
}
ADDED_SIZES = {
    "nip_day_test_hh": ("ip", "day", "in_test_hh"),
    "nip": ("ip",),
    "napp": ("app",),
    "ndevice": ("device",),
    "nos": ("os",),
    "nchannel": ("channel",),
    "nip_day_h": ("ip", "day", "hour"),
    "nip_h_chan": ("ip", "hour", "channel"),
    "nip_h_osr": ("ip", "hour", "os"),
    "nip_h_app": ("ip", "hour", "app"),
    "nip_h_dev": ("ip", "hour", "device"),
    "napp_channel": ("app", "channel"),
    "nip_h_app_channel": ("ip", "hour", "app", "channel"),
    "nip_wday_test_hh": ("ip", "wday", "in_test_hh"),
    "n_ip": ("ip", "wday", "hour"),
    "n_ip_os": ("ip", "wday", "hour", "os"),
    "n_ip_app": ("ip", "wday", "hour", "app"),
    "n_ip_app_os": ("ip", "wday", "hour", "app", "os"),
    "n_app": ("app", "wday", "hour"),
}

# Rows of a group that have a channel.
CHANNEL_COUNTS = {
    "n_ip_day_test_hh": ("ip", "day", "in_test_hh"),
    "n_ip_day_hh": ("ip", "day", "hour"),
    "n_ip_os_day_hh": ("ip", "os", "day", "hour"),
    "n_ip_app_day_hh": ("ip", "app", "day", "hour"),
    "n_ip_app_os_day_hh": ("ip", "app", "os", "day", "hour"),
    "n_app_day_hh": ("app", "day", "hour"),
    "n_ip_app_dev_os": ("ip", "app", "device", "os"),
    "n_ip_dev_os": ("ip", "device", "os"),
}

# Group sizes by weekday.
WEEKDAY_SIZES = {
    "nip_day_test_hh": ("ip", "wday", "in_test_hh"),
    "n_ip": ("ip", "wday", "hour"),
    "n_ip_os": ("ip", "wday", "hour", "os"),
    "n_ip_app": ("ip", "wday", "hour", "app"),
    "n_ip_app_os": ("ip", "wday", "hour", "app", "os"),
    "n_app": ("app", "wday", "hour"),
}

# (keys, column) of distinct counts, means and variances.
DISTINCT_COUNTS = (
    (("ip",), "channel"),
    (("ip", "device", "os"), "app"),
    (("ip", "day"), "hour"),
    (("ip",), "app"),
    (("ip", "app"), "os"),
    (("ip",), "device"),
    (("app",), "channel"),
    (("os", "device", "app", "channel"), "hour"),
    (("ip", "day"), "in_test_hh"),
    (("ip", "device", "os"), "channel"),
)
MEANS = (
    (("ip", "device", "os"), "app"),
    (("ip", "app", "channel"), "hour"),
    (("os", "device", "app", "channel"), "hour"),
    (("ip", "app", "os"), "hour"),
    (("ip", "channel"), "hour"),
)
VARIANCES = (
    (("ip", "day", "channel"), "hour"),
    (("ip", "app", "os"), "hour"),
    (("ip", "app", "channel"), "day"),
    (("ip", "app", "os"), "in_test_hh"),
)

# (keys, column) of running counts.
RUNNING_COUNTS = (
    (("ip",), "os"),
    (("ip", "device", "os"), "app"),
    (("ip", "app", "device", "os"), "channel"),
)

# Keys of the time to the next and from the previous click.
NEXT_CLICKS = (
    ("ip", "app", "device", "os", "channel"),
    ("ip", "os", "device"),
    ("ip", "os", "device", "app"),
    ("ip", "os", "device", "channel"),
    ("ip", "os", "device", "app", "hour"),
    ("ip", "os", "device", "channel", "hour"),
    ("device",),
    ("device", "channel"),
    ("app", "device", "channel"),
    ("device", "hour"),
)
PREVIOUS_CLICKS = (
    ("ip", "channel"),
    ("ip", "os"),
)

# Gaps in seconds, 0 where there is no neighbour.
NEXT_CLICKS_FILLED = {
    "by_ipappdeviceoschannel_nextclick1": ("ip", "app", "device", "os", "channel"),
    "by_iposdevice_nextclick1": ("ip", "os", "device"),
    "by_iposdeviceapp_nextclick1": ("ip", "os", "device", "app"),
}
PREVIOUS_CLICKS_FILLED = {
    "by_ipchannel_prevclick1": ("ip", "channel"),
    "by_ipos_prevclick1": ("ip", "os"),
}

# The set with short names: distinct counts, sizes, running counts, variances, and one mean.
SHORT_DISTINCT = {
    "X0": (("ip",), "channel"),
    "X2": (("ip", "day"), "hour"),
    "X3": (("ip",), "app"),
    "X4": (("ip", "app"), "os"),
    "X5": (("ip",), "device"),
    "X6": (("app",), "channel"),
    "X8": (("ip", "device", "os"), "app"),
    "A0": (("ip", "device", "os"), "channel"),
}
SHORT_RUNNING = {
    "X7": (("ip",), "os"),
    "X1": (("ip", "device", "os"), "app"),
}
SHORT_SIZES = {
    "A1": ("ip", "app", "channel"),
    "A2": ("ip", "device", "os", "app"),
    "ip_tcount": ("ip", "day", "hour"),
    "ip_app_count": ("ip", "app"),
    "ip_app_os_count": ("ip", "app", "os"),
}
SHORT_VARIANCES = {
    "ip_tchan_count": (("ip", "day", "channel"), "hour"),
    "ip_app_os_var": (("ip", "app", "os"), "hour"),
    "ip_app_channel_var_day": (("ip", "app", "channel"), "day"),
}
SHORT_MEANS = {
    "ip_app_channel_mean_hour": (("ip", "app", "channel"), "hour"),
}
