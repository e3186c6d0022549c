"""Packet classes and predicates."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Ethernet types and IP protocol numbers, and the labels that report tables give them.
ETH_IPV4, ETH_IPV6, ETH_ARP = 0x0800, 0x86DD, 0x0806
IP_ICMP, IP_TCP, IP_UDP = 1, 6, 17

ETH_NAMES = {
    0x0800: "IPv4",
    0x86DD: "IPv6",
    0x0806: "ARP",
    0x8100: "VLAN",
    0x88CC: "LLDP",
    0x886D: "0x886D",
    0x88A8: "Q-in-Q",
    0x8809: "Slow Protocols (LACP)",
}
IP_PROTO_NAMES = {
    1: "ICMP",
    2: "IGMP",
    6: "TCP",
    17: "UDP",
    47: "GRE",
    50: "ESP",
    89: "OSPF",
    112: "VRRP/CARP",
    132: "SCTP",
}

# Infrastructure ports and group addresses treated as noise.
NOISE_PORTS = (67, 68, 137, 138, 139, 5353, 5355, 1985, 1900, 123)
NOISE_ADDRESSES = ("224.0.0.102", "224.0.0.251", "224.0.0.252", "239.255.255.250")


def protocol_class(eth_type: Column, ip_proto: Column) -> Column:
    """TCP > UDP > ICMP > other IPv4 > IPv6 > other Ethernet > other."""
    v4 = eth_type == ETH_IPV4
    return (
        F.when(v4 & (ip_proto == IP_TCP), "TCP")
        .when(v4 & (ip_proto == IP_UDP), "UDP")
        .when(v4 & (ip_proto == IP_ICMP), "ICMP")
        .when(v4, "IPv4-other")
        .when(eth_type == ETH_IPV6, "IPv6")
        .when(eth_type.isNotNull(), "Eth-other")
        .otherwise("other")
    )


def port_match(ports, sport: Column, dport: Column, side: str = "any") -> Column:
    """True when a port is wanted; no ports (or only 0) means all."""
    wanted = [p for p in ([ports] if isinstance(ports, int) else list(ports)) if p]
    if not wanted:
        return F.lit(True)
    if side == "src":
        return sport.isin(wanted)
    return sport.isin(wanted) | dport.isin(wanted)


def filter_ports(df: DataFrame, ports, side: str = "any") -> DataFrame:
    return df.filter(port_match(ports, F.col("sport"), F.col("dport"), side))


def is_noise(src_ip: Column, sport: Column, dst_ip: Column, dport: Column) -> Column:
    return (
        sport.isin(*NOISE_PORTS)
        | dport.isin(*NOISE_PORTS)
        | src_ip.isin(*NOISE_ADDRESSES)
        | dst_ip.isin(*NOISE_ADDRESSES)
        | dst_ip.startswith("255.")
        | (src_ip == "0.0.0.0")
    )


def has_prefix(payload: Column, magic: bytes) -> Column:
    """Prefix test on binary; null when the payload is shorter than the prefix."""
    return F.when(
        F.octet_length(payload) >= len(magic),
        F.substring(payload, 1, len(magic)) == F.lit(bytearray(magic)),
    )
