"""Code lists and seed rows.

Everything in this module is a fixed value of the data model: it has to be
exactly so for results to be right, and it is kept in one place as plain data.
Each list has a fixed, small length, so it travels inside the plan as a literal.
"""

# --- Fixed values: monitored points (name, city, latitude, longitude) ------------
MONITORED_POINTS = [
    ("ring_road_north", "cairo", 30.1550, 31.3200),
    ("ring_road_east", "cairo", 30.0700, 31.5200),
    ("ring_road_south", "cairo", 29.9500, 31.2800),
    ("ring_road_west", "cairo", 30.0300, 31.0500),
    ("tahrir_square", "cairo", 30.0444, 31.2357),
    ("ramses_square", "cairo", 30.0626, 31.2497),
    ("salah_salem_north", "cairo", 30.0700, 31.2900),
    ("salah_salem_south", "cairo", 30.0100, 31.3000),
    ("corniche_downtown", "cairo", 30.0550, 31.2280),
    ("cairo_airport", "cairo", 30.1219, 31.4056),
    ("6th_october_bridge", "cairo", 30.0544, 31.2230),
    ("mehwar_north", "cairo", 30.0800, 31.1800),
    ("giza_square", "cairo", 30.0082, 31.2114),
    ("new_admin_capital", "cairo", 30.0131, 31.7392),
    ("new_cairo_90th", "cairo", 30.0050, 31.4700),
    ("alex_corniche_east", "alexandria", 31.2156, 29.9553),
    ("alex_corniche_west", "alexandria", 31.2050, 29.8800),
    ("alex_victoria_square", "alexandria", 31.1980, 29.9100),
    ("alex_port_area", "alexandria", 31.2000, 29.8650),
    ("alex_montaza", "alexandria", 31.2800, 30.0100),
    ("alex_abu_qir_road", "alexandria", 31.2600, 30.0600),
]

# --- Fixed values: incident areas (name, city, min lat, min lon, max lat, max lon)
AREAS = [
    ("cairo_downtown", "cairo", 30.00, 31.18, 30.12, 31.35),
    ("cairo_east", "cairo", 30.00, 31.35, 30.15, 31.55),
    ("cairo_ring_road", "cairo", 29.92, 31.05, 30.18, 31.60),
    ("alexandria", "alexandria", 31.15, 29.82, 31.30, 30.10),
]

UNKNOWN_CITY = "unknown"

# --- Fixed values: functional road classes --------------------------------------
ROAD_CLASSES = {
    "FRC0": "Motorway / Freeway",
    "FRC1": "Major Road",
    "FRC2": "Secondary Road",
    "FRC3": "Connecting Road",
    "FRC4": "Minor Road",
    "FRC5": "Local Road",
    "FRC6": "Private / Unpaved Road",
}

# --- Fixed values: magnitude of delay -------------------------------------------
MAGNITUDES = {0: "Unknown", 1: "Minor", 2: "Moderate", 3: "Major", 4: "Undefined"}

# --- Fixed values: incident categories as the feed numbers them -----------------
CATEGORIES = {
    0: "Unknown",
    1: "Accident",
    2: "Fog",
    3: "Dangerous conditions",
    4: "Rain",
    5: "Ice",
    6: "Jam",
    7: "Lane closed",
    8: "Road closed",
    9: "Road works",
    10: "Wind",
    11: "Flooding",
    14: "Broken down vehicle",
}

UNKNOWN_LABEL = "Unknown"
CLOSURE_CATEGORY = "road closed"

# --- Fixed values: bands (lower bound inclusive, label), highest first -----------
CONGESTION_BANDS = [(0.95, "free_flow"), (0.75, "light"), (0.50, "moderate")]
CONGESTION_FLOOR = "heavy"
CONGESTION_CLOSED = "road_closed"
CONFIDENCE_BANDS = [(0.8, "high"), (0.5, "medium")]
CONFIDENCE_FLOOR = "low"

# --- Fixed values: windows ------------------------------------------------------
WINDOW = "15 minutes"
WINDOW_MINUTES = 15
WATERMARK = "2 minutes"

# --- Fixed values: calendar -----------------------------------------------------
CALENDAR_FIRST_DAY = "2024-01-01"
CALENDAR_LAST_DAY = "2026-12-31"
MONTHS_AR = ["يناير", "فبراير", "مارس", "أبريل", "مايو", "يونيو",
             "يوليو", "أغسطس", "سبتمبر", "أكتوبر", "نوفمبر", "ديسمبر"]
DAYS_AR = ["الاثنين", "الثلاثاء", "الأربعاء", "الخميس", "الجمعة", "السبت", "الأحد"]
SEASONS = ["Winter", "Spring", "Summer", "Autumn"]  # from December, three months each
WEEKEND_ISO_DAYS = [5, 6]
PEAK_AM_HOURS = (7, 9)
PEAK_PM_HOURS = (16, 19)
OVERNIGHT_BEFORE_HOUR = 5

# (month, day, name, years)
PUBLIC_HOLIDAYS = [
    (1, 1, "New Year's Day", [2024]),
    (1, 25, "January 25 Revolution", [2024, 2025, 2026]),
    (4, 25, "Sinai Liberation Day", [2024, 2025, 2026]),
    (5, 1, "Labour Day", [2024, 2025, 2026]),
    (6, 30, "30 June Revolution", [2024, 2025, 2026]),
    (7, 23, "July 23 Revolution", [2024, 2025, 2026]),
    (10, 6, "Armed Forces Day", [2024, 2025, 2026]),
]

# --- Fixed values: incident category dimension ----------------------------------
# (key, raw name, icon id, English, Arabic, group, severity, rank, closes the road)
CATEGORY_SEED = [
    ("jam", "Jam", 1, "Traffic Jam", "ازدحام مروري", "Congestion", "medium", 2, False),
    ("road_closed", "Road closed", 6, "Road Closure", "إغلاق طريق", "Closure", "critical", 4, True),
    ("accident", "Accident", 3, "Accident", "حادث", "Hazard", "high", 3, False),
    ("road_works", "Road works", 8, "Road Works", "أعمال طريق", "Hazard", "medium", 2, False),
    ("dangerous_conditions", "Dangerous conditions", 9, "Dangerous Conditions", "ظروف خطرة",
     "Hazard", "high", 3, False),
    ("car_stopped", "Car stopped", 2, "Stopped Vehicle", "مركبة متوقفة", "Hazard", "low", 1, False),
    ("flooding", "Flooding", 5, "Flooding", "فيضانات", "Hazard", "critical", 4, True),
    ("broken_down", "Broken down vehicle", 10, "Broken Down Vehicle", "مركبة معطلة",
     "Hazard", "low", 1, False),
    ("unknown", "Unknown", 0, "Unknown", "غير معروف", "Other", "low", 1, False),
]

# --- Fixed values: location dimension -------------------------------------------
# (key, name, governorate, zone, road class, latitude, longitude)
LOCATION_SEED = [
    ("tahrir_square", "Tahrir Square", "Cairo", "Downtown Cairo", "FRC2", 30.0444, 31.2358),
    ("cairo_airport", "Cairo Airport", "Cairo", "Airport Corridor", "FRC1", 30.1219, 31.4056),
    ("ring_road_north", "Cairo Ring Road North", "Cairo", "Ring Road", "FRC0", 30.1200, 31.3100),
    ("ring_road_east", "Cairo Ring Road East", "Cairo", "Ring Road", "FRC0", 30.0700, 31.4000),
    ("ring_road_south", "Cairo Ring Road South", "Cairo", "Ring Road", "FRC0", 29.9800, 31.3100),
    ("ring_road_west", "Cairo Ring Road West", "Cairo", "Ring Road", "FRC0", 30.0500, 31.1800),
    ("6th_october_bridge", "6th October Bridge", "Cairo", "Downtown Cairo", "FRC1", 30.0520, 31.2280),
    ("new_admin_capital", "New Administrative Capital", "Cairo", "East Cairo", "FRC1", 30.0167, 31.7333),
    ("giza_square", "Giza Square", "Giza", "Giza", "FRC2", 30.0082, 31.2113),
    ("giza_pyramids", "Giza Pyramids Road", "Giza", "Giza", "FRC2", 29.9769, 31.1313),
    ("salah_salem_north", "Salah Salem North", "Cairo", "Downtown Cairo", "FRC2", 30.0650, 31.2800),
    ("salah_salem_south", "Salah Salem South", "Cairo", "Downtown Cairo", "FRC2", 30.0350, 31.2700),
    ("corniche_downtown", "Nile Corniche Downtown", "Cairo", "Downtown Cairo", "FRC2", 30.0450, 31.2280),
    ("ramses_square", "Ramses Square", "Cairo", "Downtown Cairo", "FRC2", 30.0626, 31.2497),
    ("new_cairo_90th", "New Cairo 90th Street", "Cairo", "East Cairo", "FRC2", 30.0200, 31.4700),
    ("mehwar_north", "Al Mehwar North", "Giza", "6th of October", "FRC1", 30.0800, 31.0600),
    ("alex_corniche_east", "Alexandria Corniche East", "Alexandria", "Eastern Corniche", "FRC2",
     31.2321, 29.9553),
    ("alex_corniche_west", "Alexandria Corniche West", "Alexandria", "Western Corniche", "FRC2",
     31.2100, 29.9000),
    ("alex_victoria_square", "Alexandria Victoria Square", "Alexandria", "Central Alexandria", "FRC2",
     31.2156, 29.9553),
    ("alex_port_area", "Alexandria Port Area", "Alexandria", "Port", "FRC2", 31.2001, 29.8952),
    ("alex_montaza", "Alexandria Montaza", "Alexandria", "Eastern Alexandria", "FRC3", 31.2846, 30.0191),
    ("alex_abu_qir_road", "Alexandria Abu Qir Road", "Alexandria", "Eastern Alexandria", "FRC1",
     31.3200, 30.0700),
    ("alexandria_corniche", "Alexandria Corniche", "Alexandria", "Central Corniche", "FRC2",
     31.2200, 29.9300),
]
LOCATION_VALID_FROM = "2024-01-01"

# --- Fixed values: road type of a road class; the city of a governorate ----------
ROAD_TYPE_OF_CLASS = {"FRC0": "highway", "FRC1": "highway", "FRC2": "arterial", "FRC3": "local"}
CITY_OF_GOVERNORATE = {"Cairo": "cairo", "Giza": "cairo", "Alexandria": "alexandria"}




CITY_OF_PLACE = {row[0]: row[1] for row in MONITORED_POINTS + AREAS}
