"""The canonical schemas and the fixed values of the domain."""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Feature names in canonical order.
# ---------------------------------------------------------------------------
FLOW_FEATURES = [
    "fwd_packet_count", "bwd_packet_count",
    "total_fwd_bytes", "total_bwd_bytes",
    "fwd_pkt_len_mean", "fwd_pkt_len_std", "fwd_pkt_len_min", "fwd_pkt_len_max",
    "bwd_pkt_len_mean", "bwd_pkt_len_std", "bwd_pkt_len_min", "bwd_pkt_len_max",
    "flow_duration",
    "flow_bytes_per_sec", "flow_pkts_per_sec",
    "iat_mean", "iat_std", "iat_min", "iat_max",
    "fwd_iat_mean", "fwd_iat_std", "fwd_iat_min", "fwd_iat_max",
    "bwd_iat_mean", "bwd_iat_std", "bwd_iat_min", "bwd_iat_max",
    "fwd_bwd_byte_ratio", "fwd_bwd_pkt_ratio",
    "header_ratio", "payload_ratio",
    "active_mean", "idle_mean",
]

# The features the default training configuration leaves out.
UNSELECTED_FEATURES = ["fwd_iat_min", "fwd_iat_max", "bwd_iat_min", "bwd_iat_max"]
SELECTED_FEATURES = [f for f in FLOW_FEATURES if f not in UNSELECTED_FEATURES]

# ---------------------------------------------------------------------------
# Column names of the published data sets -> canonical names.
# ---------------------------------------------------------------------------
UNSW_COLUMNS = {
    "spkts": "fwd_packet_count",
    "dpkts": "bwd_packet_count",
    "sbytes": "total_fwd_bytes",
    "dbytes": "total_bwd_bytes",
    "smean": "fwd_pkt_len_mean",
    "dmean": "bwd_pkt_len_mean",
    "dur": "flow_duration",
    "rate": "flow_bytes_per_sec",
    "sinpkt": "fwd_iat_mean",
    "dinpkt": "bwd_iat_mean",
    "attack_cat": "label",
}

ISCX_COLUMNS = {
    "total_fwd_packets": "fwd_packet_count",
    "total_backward_packets": "bwd_packet_count",
    "total_length_of_fwd_packets": "total_fwd_bytes",
    "total_length_of_bwd_packets": "total_bwd_bytes",
    "fwd_packet_length_mean": "fwd_pkt_len_mean",
    "fwd_packet_length_std": "fwd_pkt_len_std",
    "fwd_packet_length_min": "fwd_pkt_len_min",
    "fwd_packet_length_max": "fwd_pkt_len_max",
    "bwd_packet_length_mean": "bwd_pkt_len_mean",
    "bwd_packet_length_std": "bwd_pkt_len_std",
    "bwd_packet_length_min": "bwd_pkt_len_min",
    "bwd_packet_length_max": "bwd_pkt_len_max",
    "flow_duration": "flow_duration",
    "flow_bytes/s": "flow_bytes_per_sec",
    "flow_packets/s": "flow_pkts_per_sec",
    "flow_iat_mean": "iat_mean",
    "flow_iat_std": "iat_std",
    "flow_iat_min": "iat_min",
    "flow_iat_max": "iat_max",
    "fwd_iat_total": "fwd_iat_mean",
    "bwd_iat_total": "bwd_iat_mean",
}

CIC_COLUMNS = {
    "Total Fwd Packets": "fwd_packet_count",
    "Total Backward Packets": "bwd_packet_count",
    "Total Length of Fwd Packets": "total_fwd_bytes",
    "Total Length of Bwd Packets": "total_bwd_bytes",
    "Fwd Packet Length Mean": "fwd_pkt_len_mean",
    "Fwd Packet Length Std": "fwd_pkt_len_std",
    "Fwd Packet Length Min": "fwd_pkt_len_min",
    "Fwd Packet Length Max": "fwd_pkt_len_max",
    "Bwd Packet Length Mean": "bwd_pkt_len_mean",
    "Bwd Packet Length Std": "bwd_pkt_len_std",
    "Bwd Packet Length Min": "bwd_pkt_len_min",
    "Bwd Packet Length Max": "bwd_pkt_len_max",
    "Flow Duration": "flow_duration",
    "Flow Bytes/s": "flow_bytes_per_sec",
    "Flow Packets/s": "flow_pkts_per_sec",
    "Flow IAT Mean": "iat_mean",
    "Flow IAT Std": "iat_std",
    "Flow IAT Min": "iat_min",
    "Flow IAT Max": "iat_max",
    "Fwd IAT Mean": "fwd_iat_mean",
    "Fwd IAT Std": "fwd_iat_std",
    "Fwd IAT Min": "fwd_iat_min",
    "Fwd IAT Max": "fwd_iat_max",
    "Bwd IAT Mean": "bwd_iat_mean",
    "Bwd IAT Std": "bwd_iat_std",
    "Bwd IAT Min": "bwd_iat_min",
    "Bwd IAT Max": "bwd_iat_max",
    "Fwd Header Length": "fwd_header_len",
    "Bwd Header Length": "bwd_header_len",
    "Average Packet Size": "avg_pkt_size",
    "Avg Fwd Segment Size": "fwd_seg_size_mean",
    "Avg Bwd Segment Size": "bwd_seg_size_mean",
    "Label": "label",
}

# ---------------------------------------------------------------------------
# Label taxonomy.
# ---------------------------------------------------------------------------
LABEL_TAXONOMY = {
    "BENIGN": "Normal",
    "DoS Hulk": "DoS",
    "DoS GoldenEye": "DoS",
    "DoS slowloris": "DoS",
    "DoS Slowhttptest": "DoS",
    "Heartbleed": "DoS",
    "DDoS": "DoS",
    "FTP-Patator": "Brute Force",
    "SSH-Patator": "Brute Force",
    "Bot": "Reconnaissance",
    "PortScan": "Reconnaissance",
}
LABEL_CONTAINS = {"Web Attack": "Web Attack"}
DEFAULT_LABEL = "Normal"
DROPPED_CLASSES = ["Infiltration"]
MAX_PER_CLASS = 40_000
MIN_PER_CLASS = 500

# ---------------------------------------------------------------------------
# Caps and transforms of the cleaning profile.
# ---------------------------------------------------------------------------
HARD_CAPS = {
    "fwd_packet_count": 10_000.0,
    "bwd_packet_count": 10_000.0,
    "flow_bytes_per_sec": 125_000.0,
    "flow_pkts_per_sec": 10_000.0,
    "total_fwd_bytes": 100_000_000.0,
    "total_bwd_bytes": 100_000_000.0,
    "fwd_bwd_byte_ratio": 1_000.0,
    "fwd_pkt_len_max": 1_500.0,
    "bwd_pkt_len_max": 1_500.0,
    "fwd_iat_max": 60.0,
    "bwd_iat_max": 60.0,
    "iat_max": 60.0,
    "active_mean": 300.0,
    "idle_mean": 300.0,
    "flow_duration": 100.0,
}

# The caps that the live scorers apply.
LIVE_CAPPED = [
    "fwd_packet_count", "bwd_packet_count",
    "flow_bytes_per_sec", "flow_pkts_per_sec",
    "total_fwd_bytes", "total_bwd_bytes",
    "flow_duration",
]

# Features that receive log1p.
LOG_FEATURES = [
    "fwd_packet_count", "bwd_packet_count",
    "flow_bytes_per_sec", "flow_pkts_per_sec",
    "total_fwd_bytes", "total_bwd_bytes",
    "fwd_pkt_len_mean", "bwd_pkt_len_mean",
    "fwd_pkt_len_std", "fwd_pkt_len_min", "fwd_pkt_len_max",
    "bwd_pkt_len_std", "bwd_pkt_len_min", "bwd_pkt_len_max",
    "fwd_bwd_byte_ratio", "fwd_bwd_pkt_ratio",
    "fwd_iat_mean", "bwd_iat_mean", "iat_mean",
    "fwd_iat_max", "bwd_iat_max", "iat_max",
    "fwd_iat_std", "bwd_iat_std", "iat_std",
    "active_mean", "idle_mean",
]

# Positions in FLOW_FEATURES that the live scorers log.
LIVE_LOG_POSITIONS = [
    0, 1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 11, 13, 14, 15, 16, 19, 20, 23, 24, 27, 28, 30, 31,
]

# Confidence below which a class becomes the default label.
CLASS_THRESHOLDS = {
    "Normal": 0.85,
    "DoS": 0.75,
    "Brute Force": 0.75,
    "Web Attack": 0.75,
    "Reconnaissance": 0.85,
}
DEFAULT_THRESHOLD = 0.85

# Fixed values: (mean, standard deviation) per class of the generator, for
# forward packet length, inter-arrival time and flow duration.
SYNTHETIC_CLASSES = [
    ("Web_HTTP", (500.0, 200.0), (0.05, 0.02), (30.0, 15.0)),
    ("Streaming", (1400.0, 100.0), (0.02, 0.005), (120.0, 30.0)),
    ("VoIP", (160.0, 20.0), (0.02, 0.002), (60.0, 20.0)),
    ("VPN_HTTPS", (900.0, 300.0), (0.1, 0.05), (20.0, 10.0)),
    ("P2P", (1200.0, 200.0), (0.5, 0.3), (300.0, 100.0)),
    ("Interactive", (100.0, 50.0), (0.3, 0.2), (10.0, 5.0)),
]

# ---------------------------------------------------------------------------
# Spark schemas.
# ---------------------------------------------------------------------------
FLOW_KEY = ["a_ip", "b_ip", "a_port", "b_port", "protocol"]
PACKET_SCHEMA = T.StructType(
    [
        T.StructField("packet_id", T.LongType()),
        T.StructField("ts", T.DoubleType()),
        T.StructField("src_ip", T.StringType()),
        T.StructField("dst_ip", T.StringType()),
        T.StructField("src_port", T.IntegerType()),
        T.StructField("dst_port", T.IntegerType()),
        T.StructField("protocol", T.IntegerType()),
        T.StructField("size", T.LongType()),
        T.StructField("header_size", T.LongType()),
        T.StructField("tcp_flags", T.IntegerType()),
    ]
)
TCP, UDP = 6, 17
FIN_OR_RST = 0x01 | 0x04
