"""Write small device report files (headerless CSV, stacked tables).

Two devices; each has two exports with overlapping days. Device A writes
dates as M/D/YYYY, device B as YYYY/M/D. Readings every 5 minutes, sensor
starts every 12 hours, an end event an hour before each restart.
"""

import csv
import datetime as dt
import os

WIDTH = 54


def _row(cells):
    cells = list(cells)
    return cells + [None] * (WIDTH - len(cells))


def _date(t, fmt):
    return f"{t.month}/{t.day}/{t.year}" if fmt == "mdy" else f"{t.year}/{t.month}/{t.day}"


def write_file(path, serial, fmt, start, days, index0=0):
    rows = []
    rows.append(_row(["Last Name", "First Name", "Start Date", "End Date", "Device", "MiniMed",
                      "Serial Number", serial, None, None]))
    rows.append(_row(["Doe", "Jo", _date(start, fmt), _date(start + dt.timedelta(days=days), fmt),
                      "Pump Type", "Insulin", "Firmware", "1.2", "Note", ""]))
    rows.append(_row([]))
    # pump section
    rows.append(_row(["-------", "Pump", "MiniMed", "-------"]))
    rows.append(_row(["Index", "Date", "Time", "Alert", "User Cleared Alerts", "Basal Rate (U/h)",
                      "Bolus Volume Delivered (U)", "BWZ Carb Input (grams)", "Bolus Source", "Bolus Number"]))
    n = days * 288
    for i in range(0, n, 24):
        t = start + dt.timedelta(minutes=5 * i, seconds=40)
        alert = "Low" if i % 240 == 120 else None
        rows.append(_row([str(index0 + i), _date(t, fmt), t.strftime("%H:%M:%S"), alert, None,
                          "0.8" if i % 48 == 0 else "", "2.5" if i % 72 == 0 else "",
                          "30" if i % 72 == 0 else "", "BOLUS_WIZARD" if i % 72 == 0 else None, str(i)]))
    rows.append(_row([]))
    # a section that is read but never used
    rows.append(_row(["-------", "Aggregated", "-------"]))
    rows.append(_row(["Index", "Date", "Time", "Value"]))
    rows.append(_row(["0", _date(start, fmt), "00:00:00", "1"]))
    rows.append(_row([]))
    # sensor section
    rows.append(_row(["-------", "Sensor", "Guardian", "-------"]))
    rows.append(_row(["Index", "Date", "Time", "Event Marker", "Sensor Glucose (mg/dL)", "ISIG Value",
                      "Sensor Exception"]))
    for i in range(n):
        t = start + dt.timedelta(minutes=5 * i, seconds=10)
        k = (index0 + i) % 144
        exc = None
        if k == 0:
            exc = "SENSOR_INIT_CODE"
        elif k == 132:
            exc = "SENSOR_END_OF_LIFE" if (index0 + i) % 288 == 132 else "SENSOR_CHANGE_SENSOR_ERROR"
        glucose = "" if k in (1, 2, 3) else str(100 + (index0 + i) % 37)
        isig = f"{20 + ((index0 + i) % 11) / 2:.2f}" if glucose else ""
        marker = "Start of the day" if t.hour == 0 and t.minute < 5 else None
        rows.append(_row([str(index0 + i), _date(t, fmt), t.strftime("%H:%M:%S"), marker, glucose, isig, exc]))
    with open(path, "w", newline="") as f:
        w = csv.writer(f)
        for r in rows:
            if all(c is None for c in r):
                f.write("\n")
            else:
                w.writerow(["" if c is None else c for c in r])


def write_reports(folder):
    start = dt.datetime(2024, 11, 1)
    paths = []
    for serial, fmt in (("NG-A", "mdy"), ("NG-B", "ymd")):
        for part, (offset, days) in enumerate(((0, 2), (1, 2))):
            p = os.path.join(folder, f"{serial}_{part}.csv")
            write_file(p, serial, fmt, start + dt.timedelta(days=offset), days, index0=offset * 288)
            paths.append(p)
    return paths
