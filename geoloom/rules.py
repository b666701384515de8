"""The classification vocabulary of the layers."""

# Fixed values.
ROAD_TYPES = [
    "motorway", "trunk", "primary", "secondary", "tertiary", "unclassified", "residential",
    "service", "motorway_link", "trunk_link", "primary_link", "secondary_link", "tertiary_link",
]
POI_AMENITIES = [
    "restaurant", "cafe", "bar", "pub", "fast_food", "fuel", "hospital", "pharmacy", "bank",
    "atm", "post_office", "school", "university", "library", "place_of_worship",
]
POI_SHOPS = [
    "supermarket", "convenience", "clothes", "electronics", "bakery", "butcher", "car_repair",
    "hairdresser",
]
POI_TOURISM = ["hotel", "motel", "hostel", "museum", "attraction", "viewpoint", "information"]
BUILDING_WAY_TYPES = ["yes", "house", "apartments", "commercial", "industrial"]
ROAD_CLASSES = {
    "highway": ["motorway", "trunk"],
    "arterial": ["primary", "secondary"],
    "collector": ["tertiary", "unclassified"],
}
IMPORTANCE = {
    10: ["hospital", "school", "university"],
    8: ["restaurant", "fuel", "bank"],
    7: ["supermarket", "pharmacy"],
}
BUILDING_CLASSES = {
    "residential": ["house", "detached", "residential"],
    "commercial": ["commercial", "retail", "office"],
    "industrial": ["industrial", "warehouse"],
    "institutional": ["school", "hospital", "church"],
}
DEFAULT_IMPORTANCE = 5
METERS_PER_LEVEL = 3.0
MIN_BUILDING_AREA = 10.0
EARTH_RADIUS_M = 6371008.8
MERCATOR_RADIUS_M = 6378137.0
MAX_MERCATOR_LAT = 85.05112878
